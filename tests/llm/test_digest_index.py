"""Decisions against plain grouping, batches against a persistent index, hot digests, odd rows."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from starmill.llm import digest_index, queries
from starmill.operators import skew
from starmill.session import scratch_path


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def decided(docs, index, batch=0):
    rows = digest_index.decide(docs, index, batch).withColumn("sha", F.lower(F.hex("digest")))
    return sorted(map(tuple, rows.select("doc_id", "keep_id", "group_size", "kept", "sha").collect()), key=str)


def test_decisions_equal_grouping(spark, documents, odd_documents):
    for docs in (documents, odd_documents):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert decided(docs, digest_index.new_index(spark)) == brute(rows)


def test_hot_digests_are_split_off_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(digest_index, "HOT_SHARE", 8)
    rows = [(i, "the same" if i % 3 else f"text {i % 50}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert decided(docs, digest_index.new_index(spark)) == brute(rows)


def test_later_batches_meet_what_earlier_ones_left(spark):
    path = scratch_path(spark, "index")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "b"), (5, "c"), (6, "c"), (7, None)], "doc_id long, text string")
    index = digest_index.DigestIndex(spark, path, buckets=3)
    assert sorted(r.doc_id for r in digest_index.keep(first, index, 0).collect()) == [2, 3]
    opened = digest_index.DigestIndex(spark, path, buckets=3)
    assert sorted(r.doc_id for r in digest_index.keep(second, opened, 1).collect()) == [6, 7]
    assert opened.entries().count() == 4
    again = digest_index.DigestIndex(spark, path, buckets=3)
    assert digest_index.keep(first, again, 2).count() == 0 and again.entries().count() == 4


def test_batches_without_a_number_are_different_ones(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    more = spark.createDataFrame([(1, "a"), (3, "c")], "doc_id long, text string")
    index = digest_index.new_index(spark)
    assert [sorted(r.doc_id for r in digest_index.keep(d, index).collect()) for d in (docs, docs, more)] == [[1, 2], [], [3]]
    assert sorted(r.batch for r in index.entries().collect()) == [0, 0, 1]


def kept(docs, index, batch):
    return sorted(r.doc_id for r in digest_index.keep(docs, index, batch).collect())


def test_a_repeated_batch_keeps_the_same_rows(spark):
    """However far a run came before it failed, before or within or after the append."""
    earlier = spark.createDataFrame([(1, "a"), (2, "z")], "doc_id long, text string")
    rows = [(10 + i, f"text {i // 2}") for i in range(40)] + [(90, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = [11 + 2 * i for i in range(20)]

    index = digest_index.new_index(spark)
    digest_index.keep(earlier, index, 0)
    digest_index.decide(docs, index, 1)  # appended, and its output lost
    assert kept(docs, index, 1) == expected and kept(docs, index, 1) == expected
    assert kept(docs, index, 2) == []

    index = digest_index.new_index(spark)
    digest_index.keep(earlier, index, 0)
    groups = digest_index.groups_of(digest_index.pick(docs).select("doc_id", digest_index.digest_of().alias("digest")))
    index.add(groups.where("keep_id % 4 = 1"), 1)  # some of the buckets' tasks came through
    assert kept(docs, index, 1) == expected
    assert index.entries().count() == 22 and index.entries().select("digest").distinct().count() == 22


def test_a_compacted_index_is_read_in_its_order(spark):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "index"), buckets=3)
    batches = [spark.createDataFrame([(100 * b + i, f"{b} {i}") for i in range(30)], "doc_id long, text string") for b in range(3)]
    for docs in batches:
        digest_index.keep(docs, index)
    small = index.compacted(scratch_path(spark, "index"))
    assert sorted(map(tuple, small.entries().collect())) == sorted(map(tuple, index.entries().collect()))
    assert len(small.entries().inputFiles()) == 3 < len(index.entries().inputFiles())
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    try:
        new = batches[0].select(F.unhex(F.sha2("text", 256)).alias("digest")).repartition(3, "digest")
        joined = new.join(small.entries().hint("merge"), "digest", "left_anti")
        assert joined.count() == 0
        assert joined._jdf.queryExecution().executedPlan().toString().count("Sort [digest") == 1
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
    assert kept(batches[1], small, 7) == []


def test_the_index_is_not_moved_for_the_anti_join(spark):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "index"), buckets=4)
    groups = spark.range(10).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    index.add(groups)
    joined = groups.repartition(4, "digest").join(index.entries().hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert joined.count() == 0


def test_kept_rows_have_all_columns(spark, odd_documents, no_documents):
    kept = digest_index.keep(odd_documents, digest_index.new_index(spark))
    assert kept.columns == odd_documents.columns
    texts = [r.text or "" for r in kept.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({r.text or "" for r in odd_documents.select("text").collect()})
    assert digest_index.keep(no_documents, digest_index.new_index(spark)).count() == 0


def test_query_is_native(spark, sf_dir):
    plan = queries.op4_exact_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_counted_join_equals_a_plain_one(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id % 400) as k", "id")
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    got = skew.join_counted(rows, lookup, ["k"], "n", share=16).select("k", "id", "n", "m")
    assert sorted(got.collect()) == sorted(rows.join(lookup, "k").select("k", "id", "n", "m").collect())
