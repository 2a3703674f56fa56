"""The sum property, likeness against counted runs, neighbours against a sorted list."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from starmill.llm import fingerprints as fp
from starmill.llm import queries


def test_order_does_not_matter_and_paragraphs_come_and_go():
    parts = ["one line here", "another", "", "ein drittes ö", "another"]
    whole = fp.fingerprint("\n".join(parts))
    shuffled = parts[:]
    random.Random(2).shuffle(shuffled)
    assert (fp.fingerprint("\n".join(shuffled)) == whole).all()
    less = fp.delete(whole, "another")
    assert (less == fp.fingerprint("\n".join(parts[:4]))).all()
    assert (fp.insert(less, "another") == whole).all()
    assert not (fp.fingerprint("\n".join([*parts, "another"])) == whole).all()


def runs(text):
    return Counter(line[i : i + fp.RUN] for line in text.split("\n") for i in range(len(line)))


def test_likeness_is_near_the_counted_one(documents):
    texts = [r.text for r in documents.orderBy("doc_id").limit(60).collect() if len(r.text) > 200]
    off = []
    for a, b in zip(texts, texts[1:]):
        for x, y in ((a, fp.edited(a, b)), (a, b)):
            p, q = runs(x), runs(y)
            most = max(sum(n * n for n in p.values()), sum(n * n for n in q.values()))
            off.append(fp.likeness(fp.fingerprint(x), fp.fingerprint(y)) - min(1, sum(p[r] * q[r] for r in p) / most))
    assert np.abs(off).mean() < 0.08 and np.abs(off).max() < 0.4


def test_long_texts_are_sketched_in_chunks(monkeypatch):
    text = ("word " * 40 + "\n") * 9
    whole = fp.fingerprint(text)
    monkeypatch.setattr(fp, "CHUNK", 50)
    assert (fp.fingerprint(text) == whole).all()


def expected(rows):
    """doc_id, n_chars, digest of the edited text, by one sorted list."""
    texts = sorted((i, t or "") for i, t in rows if i is not None)
    out = []
    for n, (i, t) in enumerate(texts):
        following = texts[(n + 1) % len(texts)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), t, changed, following))
    for i, t in rows:
        if i is None:
            t = t or ""
            changed = t[: len(t) - len(t) // 2]
            out.append((None, len(t), hashlib.sha256(changed.encode()).hexdigest(), t, changed, ""))
    return out


@pytest.mark.parametrize("table", ["documents", "odd_documents"])
def test_neighbours(table, request):
    docs = request.getfixturevalue(table)
    want = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = fp.with_neighbours(docs).collect()
    order = lambda x: (x[0] is None, *(x[0] or 0, *x[1:]))
    rows = []
    for i, n, sha, text, changed, following in want:
        own, other, after = map(fp.fingerprint, (text, changed, following))
        rows.append((i, n, sha, fp.shown(own), fp.shown(other), fp.likeness(own, other), fp.likeness(own, after)))
    assert sorted(map(tuple, got), key=order) == sorted(rows, key=order)


def test_no_rows_and_one_row(no_documents, odd_documents):
    assert fp.with_neighbours(no_documents).count() == 0
    (row,) = fp.with_neighbours(odd_documents.where("doc_id = 8")).collect()
    assert row.near_next == 1.0 and row.n_chars == len("\x00 é ﬁ 日本 😀 ▁ <s> tail")


def test_edited_texts_are_nearer_than_the_next(spark, sf_dir):
    rows = queries.op2_fingerprints(spark, sf_dir).where("n_chars > 100").collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
    assert 0.35 < np.median([r.near_edited for r in rows]) < 0.65 and np.median([r.near_next for r in rows]) < 0.2
