"""Marginals against all state sequences, the gradient, held-out accuracy, spans."""

import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from starmill.llm import queries, toxicity


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(3)
    lengths = [1, 4, 2, 7, 1, 5]
    ends = np.cumsum(lengths)
    emission, moves = draw.normal(size=ends[-1]) * 2, draw.normal(size=(2, 2))
    forward, backward = toxicity.forward_backward(emission, ends, moves)
    got = 1 / (1 + np.exp(-(forward + backward)))
    for a, b in zip([0, *ends[:-1]], ends):
        total, on = 0.0, np.zeros(b - a)
        for states in product((0, 1), repeat=b - a):
            weight = np.exp(sum(e * s for e, s in zip(emission[a:b], states)) + sum(moves[x, y] for x, y in zip(states, states[1:])))
            total += weight
            on += weight * np.array(states)
        assert np.allclose(got[a:b], on / total)


def test_markers_are_the_words_that_explain():
    docs = {1: {"bad", "with"}, 2: {"bad", "with"}, 3: {"bad"}, 4: {"vile"}, 5: {"vile", "with"}, 6: {"once"}}
    assert toxicity.markers(docs) == ["bad", "vile"]


def test_markers_pay_for_their_other_documents():
    docs = {n: {"los+", "loser"} for n in range(10)} | {10: {"los+"}, 11: {"the"}, 12: {"the"}}
    assert toxicity.markers(docs, {"los+": 3, "loser": 0.5, "the": 2}) == ["loser"]


def test_marks_are_told_by_shares_and_unmarked_documents_teach_nothing(spark):
    texts = [("a vile word" if i < 20 else "a kind and odd word", 1) for i in range(24)]
    texts += [("a vile word" if i < 5 else "a kind and odd word", 0) for i in range(1_000)]
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, label int")
    assert toxicity._cover(rows) == ["vil+"]
    got = toxicity._labelled_chains(rows, {"vil+"})
    assert sum(any(tags) for _, tags in got) == 20 and len(got) == 1_020


def test_chains_hold_every_word_once():
    words, ends = toxicity.chains("One two. Three!\nfour five\n\n " + "x " * 600 + "end")
    assert words[:5] == ["One", "two.", "Three!", "four", "five"]
    assert ends[:3] == [2, 3, 5] and ends[-1] == len(words) == 606
    assert max(np.diff([0, *ends])) == toxicity.CHAIN


def test_spans_are_code_points():
    text = "é 😀 bad worse. fine\tbad"
    assert [text[a:b] for a, b in toxicity.spans(text, np.array([2, 3, 5]))] == ["bad worse.", "bad"]


def test_held_out_labels_and_offsets(spark, documents, sf_dir):
    truth = {r.doc_id: r.toxic for r in queries.labels(spark, sf_dir).collect()}
    got = queries.op5_toxicity(spark, sf_dir).collect()
    assert len(got) == documents.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.9
    assert sorted(got) == sorted(queries.op5_toxicity(spark, sf_dir).collect())
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in got:
        for span in filter(None, r.offsets.split(",")):
            a, b = map(int, span.split(":"))
            assert texts[r.doc_id][a:b].strip() == texts[r.doc_id][a:b] != ""


def test_odd_rows_and_no_rows(odd_documents, no_documents, spark):
    words = spark.createDataFrame([(100 + i, "you vile thing." if i % 2 else "you kind thing.") for i in range(40)], "doc_id long, text string")
    labels = words.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    field = toxicity.learn(words, labels, F.lit(True))
    tagged = {r.doc_id: r for r in toxicity.tag(words, field).collect()}
    assert all((r.score >= 0.5) == (i % 2 == 1) for i, r in tagged.items())
    assert tagged[101].spans[0][:] == (4, 8)
    rows = toxicity.tag(odd_documents, field).collect()
    assert len(rows) == odd_documents.count() and all(r.score < 0.3 for r in rows if r.doc_id == 3)
    assert toxicity.tag(no_documents, field).count() == 0
    assert toxicity.learn(odd_documents, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in toxicity.tag(odd_documents, None).collect()} == {0.0}


def test_chains_are_bounded_by_tokens(spark):
    texts = [("a vile word here" if i % 2 else "a kind and odd word", i % 2) for i in range(2_000)]
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, label int")
    whole = toxicity._labelled_chains(rows, {"vil+"})
    assert len(whole) == 2_000
    some = toxicity._labelled_chains(rows, {"vil+"}, 3_000)
    assert 2_500 < sum(len(words) for words, _ in some) < 3_500
    assert some == toxicity._labelled_chains(rows.repartition(7), {"vil+"}, 3_000)
