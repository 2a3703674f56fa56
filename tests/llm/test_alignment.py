import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmill.llm import alignment

MODELS = [open(public_tokenizers.path(name), "rb").read() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def brute(texts):
    """Per text its groups as lists of ids, by walking both token lists side by side."""
    a = Tokenizer.from_buffer(MODELS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=MODELS[1])
    spell_a = alignment.byte_side(MODELS[0]).spelled
    out = []
    for text in texts:
        groups = []
        if text:
            x = a.encode(" " + text, add_special_tokens=False).ids
            y = b.encode(text)
            p = [spell_a[i] for i in x]
            q = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
            if b"".join(p) == b"".join(q) == (" " + text).encode():
                ends = {int(e) for e in np.cumsum([len(t) for t in p])} & {int(e) for e in np.cumsum([len(t) for t in q])}
                for side, (ids, spelled) in enumerate(((x, p), (y, q))):
                    at, group = 0, 0
                    for i, t in zip(ids, spelled, strict=True):
                        if group == len(groups):
                            groups.append(([], []))
                        groups[group][side].append(i)
                        at += len(t)
                        group += at in ends
        out.append(groups)
    return out


def brute_rows(texts):
    found = brute(texts)
    links = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for groups in found]
    docs = Counter(pair for counted in links for pair in counted)
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    rows = []
    for groups, counted in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(n for (a, b), n in counted.items() if docs[a, b] == most[a])
        total = sum(n * docs[pair] for pair, n in counted.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = [sum(len(g[side]) for g in groups) for side in (0, 1)]
        rows.append((*sizes, len(groups), sum(counted.values()), best, total, digest))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def results(docs):
    return [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.scored(docs, *MODELS).collect()]


def key(row):
    return tuple((v is None, v or 0) if i == 0 else v for i, v in enumerate(row))


def test_equals_brute_force_on_the_tables(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    expected = [(i, *rest) for (i, _), rest in zip(docs, brute_rows([t for _, t in docs]), strict=True)]
    assert sorted(results(documents)) == sorted(expected)


def test_odd_rows(spark, odd_documents):
    docs = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    expected = [(i, *rest) for (i, _), rest in zip(docs, brute_rows([t for _, t in docs]), strict=True)]
    assert sorted(results(odd_documents), key=key) == sorted(expected, key=key)
    empty = [r for r in results(odd_documents) if r[0] in (3, 4)]
    assert empty == [(i, 0, 0, 0, 0, 0, 0, "") for i in (3, 4)] or empty == [(i, 0, 0, 0, 0, 0, 0, "") for i in (4, 3)]


def test_texts_that_a_side_does_not_spell_have_no_tokens(spark):
    texts = ["a▁b", "plain words", "<|endoftext|> </s> <0x41>", " x　y", "tab\tand\nline", "é é 日本語 😀"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [(i, *rest) for i, rest in enumerate(brute_rows(texts))]
    assert sorted(results(docs)) == expected
    assert expected[0][1:] == (0, 0, 0, 0, 0, 0, "") and expected[2][1] > 0


def test_wide_groups_count_the_same_links(monkeypatch):
    sides = (alignment.Encoder(*MODELS),)
    texts = ["internationalisation of antidisestablishmentarianism " * 3, "", "ÄÖÜäöü ßẞ œuvre 日本語日本語 x"]
    whole = alignment.align_batch(texts, *sides)
    monkeypatch.setattr(alignment, "WIDE", 1)
    assert [c.to_pylist() for c in alignment.align_batch(texts, *sides)] == [c.to_pylist() for c in whole]


def test_cutting_a_text_changes_no_token(documents):
    assert alignment.may_cut(*MODELS)
    spaces = [" ", "  ", "\t", "\n ", " \n", "\u00a0", "\u3000", "\x1c", "\x85", "\u200b", " \u0301", " '", "' ", " 's ", "'s 't"]
    words = ["a", "Über", "12", "...", "'s", "😀", "日本", "x" * 90, "é", "<s>", "<0x41>", "<|endoftext|>", "_", "\x00", "1a", "ﬁ"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(words) + rng.choice(spaces) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    texts += ["a▁b next", "before a▁ after", *(r.text or "" for r in documents.limit(150).collect())]
    cut, whole = (alignment.Encoder(*MODELS, cut=c).tokens(texts + texts[:50]) for c in (True, False))
    for x, y in zip(cut, whole, strict=True):
        assert np.array_equal(x.ids, y.ids) and np.array_equal(x.doc, y.doc) and np.array_equal(x.end, y.end)


def test_overlaps_are_all_pairs_that_share_a_byte():
    texts = ["Straßenverkehrsordnung naïve coöperate", "", "x", "日本語 text"]
    a, b = alignment.Encoder(*MODELS).tokens(texts)
    found = set(zip(*(side.tolist() for side in alignment.overlaps(a, b)), strict=True))
    expected = {
        (i, j) for i in range(len(a.ids)) for j in range(len(b.ids)) if a.start[i] < b.end[j] and b.start[j] < a.end[i]
    }
    assert found == expected


@pytest.mark.parametrize("share", [2, 1 << 16])
def test_hot_pairs_change_nothing(spark, documents, monkeypatch, share):
    few = documents.where("doc_id < 60").withColumn("text", F.substring("text", 1, 300))
    texts = [r.text for r in few.orderBy("doc_id").collect()]
    monkeypatch.setattr(alignment, "HOT_SHARE", share)
    assert [r[1:] for r in sorted(results(few))] == brute_rows(texts)


def test_empty_table(no_documents):
    assert results(no_documents) == []
