"""Held-out accuracy, counts and scores against plain arithmetic, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starmill.llm import language, queries


def test_held_out_languages_are_predicted(spark, sf_dir, documents):
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    got = queries.op10_language(spark, sf_dir).collect()
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) >= 0.95


def plain_grams(text):
    text = " " + text
    folded = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text) + " " * language.ORDERS
    for i in range(len(text)):
        for order in range(1, language.ORDERS + 1):
            if folded[i] != " " or (order > 1 and folded[i + 1] != " "):
                yield folded[i : i + order]


def test_scores_are_naive_bayes(spark):
    texts = [("a", "Ab ba, Abba."), ("a", "aa"), ("b", "cc dd"), ("b", "CD dc é"), ("b", "")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.learn(docs, F.lit(True))

    def bucket(gram):
        chars = np.array([ord(c) for c in gram.ljust(2 * language.ORDERS)], "uint32")
        return int(language._buckets(chars, len(gram))[0])

    counts = {lang: Counter(bucket(g) for own, t in texts if own == lang for g in plain_grams(t)) for lang in "ab"}
    size = 1 << language.BUCKET_BITS
    for text in ("ab dd", "x", "CC", "a" * 9):
        raw = []
        for lang, docs_of in (("a", 2), ("b", 3)):
            total = sum(counts[lang].values()) + 0.5 * size
            raw.append(math.log(docs_of / 5) + sum(math.log((counts[lang][bucket(g)] + 0.5) / total) for g in plain_grams(text)))
        (got,), score = model.predict([text])
        assert got == "ab"[int(np.argmax(raw))]
        assert abs(score[0] - 1 / sum(math.exp(x - max(raw)) for x in raw)) < 1e-4


def test_long_texts_are_summed_in_chunks(monkeypatch):
    texts = ["abc def " * 50, "", "é" * 300, "12 34", "z"]
    whole = Counter((int(t), int(b)) for ts, bs in language.grams(texts) for t, b in zip(ts, bs))
    monkeypatch.setattr(language, "CHUNK", 64)
    assert Counter((int(t), int(b)) for ts, bs in language.grams(texts) for t, b in zip(ts, bs)) == whole


def many_languages():
    """Languages that differ in their alphabet's middle, two texts each."""
    rows = []
    for i in range(200):
        own = "".join(chr(0x4E00 + 7 * i + k) for k in range(5))
        rows += [(f"l{i:03}", f"ab {own} {own[::-1]} common"), (f"l{i:03}", f"{own} {own} 12 x{i}")]
    return rows


def test_two_hundred_languages_equal_a_plain_scorer(spark, monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 300)
    rows = many_languages()
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.learn(docs, F.lit(True))
    assert isinstance(model, language.SparseModel) and len(model.languages) == 200

    def buckets(text):
        return [int(b) for _, part in language.grams([text]) for b in part]

    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(buckets(text))
    size = 1 << language.BUCKET_BITS
    asked = ["ab common", rows[77][1], "", "12", rows[300][1] * 40, "x9 x10"]
    found, scores = model.predict(asked)
    for text, got, score in zip(asked, found, scores, strict=True):
        raw = {
            lang: math.log(2 / 400) + sum(math.log((have[b] + 0.5) / (sum(have.values()) + 0.5 * size)) for b in buckets(text))
            for lang, have in counts.items()
        }
        if not any(c.isalpha() for c in text):
            assert (got, score) == ("und", 0)
            continue
        assert raw[got] >= max(raw.values()) - 1e-3
        assert abs(score - 1 / sum(math.exp(v - max(raw.values())) for v in raw.values())) < 1e-3


def test_both_forms_of_the_matrix_agree(spark, documents):
    texts = [r.text or "" for r in documents.limit(60).collect()]
    dense = language.learn(documents, F.lit(True))
    place = {lang: i for i, lang in enumerate(dense.languages)}
    rows = documents.where("lang is not null").select("text", "lang")
    number = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    sparse = language.SparseModel(language._counts(rows, place), number)
    (a, x), (b, y) = dense.predict(texts), sparse.predict(texts)
    assert a == b
    np.testing.assert_allclose(x, y, atol=1e-3)


def test_odd_rows_and_no_rows(odd_documents, no_documents):
    model = language.learn(odd_documents, F.lit(True))
    rows = language.predict(odd_documents, model, keep=("doc_id", "text")).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (r.score == 0) == (not lettered)
    assert language.predict(no_documents, model).count() == 0
    assert language.learn(no_documents, F.lit(True)) is None
    assert {r.lang_pred for r in language.predict(odd_documents, None).collect()} == {"und"}
    assert isinstance(language._counts(odd_documents.where("lang = 'en'"), {"en": 0}), pa.Table)
