"""The codec against the sentencepiece library, whole texts and odd ones; exact round trips."""

import hashlib
import random

import pytest
import sentencepiece

from starmill.llm import pieces, queries

ODD = [
    "",
    " ",
    "  ",
    "\n",
    " a  b\n\n c ",
    "\x00\x01\t é ﬁ ﬀ 日本語 😀👍🏽 ▁ ▁▁x <s> </s> <unk> <0x0A>",
    "word***. (word) 'tis a_b c--d e.g. 3.14%",
    "a" * 3000,
    "é" * 500,
    " " * 700,
    "x y" * 400,
    "ab" * 40 + "! " + "?!" * 60,
    " line nbsp​zero﻿",
]


@pytest.fixture(scope="module")
def model():
    return queries.piece_model()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_odd_texts(model, library):
    codec = pieces.Codec(model)
    for text in ODD:
        ids = library.encode(text)
        assert codec.encode(text) == ids, text[:40]
        assert codec.decode(ids) == library.decode(ids) == text.replace(pieces.SPACE, " ")


def test_random_texts_in_slices(model, library):
    rng = random.Random(3)
    alphabet = ["a", "b", "th", "e", " ", "  ", "\n", ".", ",", "***", "é", "日", "😀", "\t", "1", "▁", "_", "-", "'"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)] + ODD
    got = pieces.Encoder(model, most=500).slice(texts, end=True).to_pylist()
    assert got == library.encode(texts, add_eos=True)


def test_agendas_in_rows_and_heaps_agree(model):
    codec = pieces.Codec(model)
    rng = random.Random(5)
    for _ in range(500):
        segment = "".join(rng.choice("aethnoirs▁é.") for _ in range(rng.randrange(1, 40)))
        assert codec.merge(segment) == codec._ids(codec._merged_long(segment))


def test_any_ids_decode_as_in_the_library(model, library):
    codec = pieces.Codec(model)
    rng = random.Random(7)
    for _ in range(3000):
        ids = [rng.randrange(3, 259) if rng.random() < 0.5 else rng.randrange(1, 32000) for _ in range(rng.randrange(10))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_a_wrong_vocabulary_is_noticed(model, monkeypatch):
    encoder = pieces.Encoder(model, most=10)
    monkeypatch.setattr(pieces.Codec, "merge_many", lambda self, segments: [b"\5\0\0\0"] * len(segments))
    with pytest.raises(ValueError, match="differ from the library"):
        encoder.slice(["qqqq zzzz unheard"], end=False)


def test_query_equals_the_library(spark, sf_dir, documents, library):
    want = {}
    for r in documents.collect():
        ids = library.encode(r.text or "", add_eos=True)
        shas = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        want[r.doc_id] = (len(ids), *shas)
    got = {r.doc_id: tuple(r)[1:4] for r in queries.op1_sentencepiece(spark, sf_dir).collect()}
    assert got == want


def test_columns_and_odd_rows(odd_documents, no_documents, model):
    encoded = pieces.encode(odd_documents, model, keep=("doc_id", "text"))
    decoded = pieces.decode(encoded, model, keep=("doc_id",))
    both = pieces.round_trip(odd_documents, model)
    texts = sorted((str(r.doc_id), r.text) for r in decoded.collect())
    assert texts == sorted((str(r.doc_id), (r.text or "").replace(pieces.SPACE, " ")) for r in odd_documents.collect())
    assert texts == sorted((str(r.doc_id), r.text) for r in both.collect())
    assert pieces.digests(no_documents, model).count() == 0


def test_words_between_spaces_are_looked_up_whole(model, library, monkeypatch):
    """Only long words and texts with other white space are cut; each cut once cost most of the time."""
    encoder = pieces.Encoder(model)
    cut, seen = pieces.Codec.segments, []
    monkeypatch.setattr(pieces.Codec, "segments", lambda self, text: seen.append(text) or cut(self, text))
    texts = ["plain words, here. \nand (there) é日 " + "x" * 60 + " end", "two  spaces", "mark ▁ in it", ", ,. \n", ""]
    for _ in range(2):
        assert encoder.slice(texts, end=False).to_pylist() == library.encode(texts)
    assert set(seen) == {"x" * 60, *texts[1:]} - {", ,. \n"}


def test_names_in_the_table_tell_segments_apart():
    segments = [",", "▁,", "▁▁,", "▁", "▁▁", "\n", "▁\n", "a", "▁a"]
    names = [pieces._key(s) for s in segments]
    assert len(set(names)) == len(names)
    assert [n[1:] if n[0] == pieces.SPACE else pieces.SPACE + n for n in names] == segments
