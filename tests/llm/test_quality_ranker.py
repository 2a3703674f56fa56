"""Held-out accuracy of the ranker, its loss, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import quality, queries


def test_held_out_labels_are_predicted(spark, sf_dir, documents):
    truth = {r.doc_id: r.quality for r in queries.labels(spark, sf_dir).collect()}
    got = queries.op7_quality(spark, sf_dir).collect()
    assert len(got) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    again = queries.op7_quality(spark, sf_dir).collect()
    assert sorted(got) == sorted(again)


def test_pairs_are_ranked_and_the_threshold_is_a_quantile():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 5))
    good = x @ [2.0, -1, 0, 0, 0.5] + draw.normal(size=4000) * 0.1 > -1
    ranker = quality.fit(x, good, pairs=5000)
    raw = ranker.raw(x)
    assert abs((raw < ranker.threshold).mean() - (~good).mean()) < 0.01
    assert ((ranker.score(x) >= quality.CUT) == good).mean() > 0.97


def test_kept_rows_are_those_at_the_cut(spark, sf_dir, documents, odd_documents):
    ranker = queries.quality_ranker(documents, queries.labels(spark, sf_dir))
    for docs in (documents, odd_documents):
        kept = quality.keep_good(docs, ranker)
        assert kept.columns == docs.columns
        want = quality.scores(docs, ranker).where(F.col("score") >= quality.CUT).select("doc_id")
        assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, want.collect()))


def test_odd_rows_and_no_rows(odd_documents, no_documents):
    labels = odd_documents.selectExpr("doc_id", "if(doc_id = 3, null, cast(doc_id % 2 as int)) as quality")
    ranker = quality.learn(odd_documents, labels, F.lit(True), pairs=100)
    assert quality.scores(odd_documents, ranker).where("score between 0 and 1").count() == odd_documents.count()
    assert quality.scores(no_documents, ranker).count() == 0
    assert quality.learn(odd_documents, labels.limit(0), F.lit(True)) is None
    assert [r.score for r in quality.scores(odd_documents, None).distinct().collect() if r.score != 0.5] == []
    assert quality.keep_good(odd_documents, None).count() == odd_documents.count()


@pytest.mark.parametrize("text", ["", " ", "a", "!!!", "x" * 100_000, "\x00\n\n", "é 日本"])
def test_features_are_finite(text):
    x = quality.features([text])
    assert np.isfinite(x).all() and x.shape == (1, quality.features([""]).shape[1])


def test_weights_are_where_the_loss_is_least():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 4))
    good = x @ [1.0, -2, 0.5, 0] + draw.normal(size=300) > 0
    ridge, pairs, seed = 1e-3, 500, 7
    ranker = quality.fit(x, good, pairs=pairs, seed=seed, ridge=ridge)
    again = np.random.default_rng(seed)
    first, second = again.choice(np.flatnonzero(good), pairs), again.choice(np.flatnonzero(~good), pairs)
    z = (x - x.mean(0)) / x.std(0)

    def loss(w):
        return np.mean([np.log1p(np.exp(-(z[a] - z[b]) @ w)) for a, b in zip(first, second)]) + ridge / 2 * w @ w

    least = loss(ranker.weights)
    for n in range(4):
        step = np.eye(4)[n] * 1e-3
        assert abs(loss(ranker.weights + step) - loss(ranker.weights - step)) / 2e-3 < 1e-5
        assert least < min(loss(ranker.weights + step), loss(ranker.weights - step))


def test_a_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3_000)] + [(2, "x"), (2, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    rows = {r.doc_id: (r.text, r.label) for r in quality.sample(docs, labels, "quality", F.lit(True), 10).collect()}
    assert rows.keys() == {1, 2, 3} and rows[2] == ("x", 1) and rows[3] == ("", 0) and rows[1][1] == 0
    assert quality.sample(docs, labels, "quality", F.lit(True), 2).count() == 2


def _junk_and_prose(spark, n, bad_every):
    """`n` texts, every `bad_every`-th of them junk, and their labels."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(n):
        words = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(int(draw.integers(5, 30)))]
        rows.append((i, " ".join(words) + ("" if i % bad_every else " !!! |||" * int(draw.integers(1, 4))), int(i % bad_every > 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(7)


def test_weights_come_from_every_labelled_document(spark, monkeypatch):
    """One block is all pairs; many blocks hold every document, each with partners of the other kind."""
    table = _junk_and_prose(spark, 300, 4)
    ranker = quality.learn(table, table, F.lit(True))
    rows = table.collect()
    x, good = quality.features([r.text for r in rows]), np.array([r.quality > 0 for r in rows])
    assert np.allclose(ranker.mean, x.mean(0)) and np.allclose(ranker.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))
    z = (x - ranker.mean) / ranker.scale
    d = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
    slope = 1e-3 * ranker.weights - d.T @ (1 / (1 + np.exp(d @ ranker.weights))) / len(d)
    assert np.abs(slope).max() < 1e-6
    raw = ranker.raw(x)
    low, high = np.quantile(raw, np.array([-0.002, 0.002]) + (~good).mean())
    assert ranker.threshold == pytest.approx((low + high) / 2, abs=1e-5)
    again = quality.learn(table.repartition(3), table, F.lit(True))
    assert (again.weights == ranker.weights).all() and again.threshold == ranker.threshold
    monkeypatch.setattr(quality, "BLOCK_ROWS", 20)
    found = quality.labelled(table, table, "quality", F.lit(True))
    blocks = quality.blocked(found, {True: 225, False: 75}, 10).collect()
    assert len(blocks) == 12
    kinds = [{g: [tuple(x.base) for x in b.docs if x.good == g] for g in (True, False)} for b in blocks]
    assert all(k[True] and k[False] for k in kinds)
    assert {t for k in kinds for g in k for t in k[g]} == {tuple(r.base) for r in found.collect()}


def test_more_than_twenty_thousand_labels_are_all_learned_from(spark):
    """The learning once stopped at 20,000 labelled documents."""
    docs = spark.range(24_000).selectExpr("id as doc_id", "if(id % 5 = 0, '!!! ||| !!!', concat('plain words in line ', id)) as text", "cast(id % 5 > 0 as int) as quality")
    ranker = quality.learn(docs, docs, F.lit(True))
    base = np.array([quality.shares(r.text) for r in docs.select("text").collect()])
    assert np.allclose(ranker.mean, quality.expanded(base).mean(0), rtol=1e-9, atol=1e-9)
    assert quality.labelled(docs, docs, "quality", F.lit(True)).count() == 24_000
