from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmill.llm import sharding


def collected(docs, shards, **options):
    rows = sharding.shard(docs, shards, **options).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    return [tuple(r) for r in rows]


def check_numbered(rows, shards):
    slots = defaultdict(list)
    for _, text, size, shard, slot in rows:
        assert size == len((text or "").encode()) + 8
        assert 0 <= shard < shards
        slots[shard].append(slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def bytes_per(rows, shards):
    total = Counter()
    for _, _, size, shard, _ in rows:
        total[shard] += size
    return [total[s] for s in range(shards)]


@pytest.mark.parametrize("options", [{}, {"range_bytes": 20_000}, {"tolerance": 0.3}])
def test_shards_of_the_tables_are_near_equal(spark, documents, options):
    rows = collected(documents, 5, **options)
    assert Counter(r[:2] for r in rows) == Counter(tuple(r) for r in documents.select("doc_id", "text").collect())
    check_numbered(rows, 5)
    total, largest = sum(r[2] for r in rows), max(r[2] for r in rows)
    slack = largest + 2 * options.get("tolerance", sharding.TOLERANCE) * total / 5
    assert max(abs(b - total / 5) for b in bytes_per(rows, 5)) <= slack


def test_cuts_are_where_counting_says(spark):
    """Every cut is the edge nearest to the wanted bytes, by brute force over the sorted keys."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 17).cast("int")).alias("text"))
    body = F.col("text")
    keys = docs.select(*sharding.key_words(F.col("doc_id"), body), sharding.size_of(body, 8).alias("size"))
    rows = sorted(tuple(r) for r in keys.collect())
    edges, below = [((*rows[0][:3], 0.0), 0)], 0
    for here, after in zip(rows, [*rows[1:], None], strict=True):
        below += here[3]
        edges.append((((*after[:3], 0.0) if after else None), below))
    targets = [(share * below, 0.0) for share in (0.001, 0.1, 0.25, 0.5, 0.9)]
    for (wanted, _), cut in zip(targets, sharding.find_cuts(keys, below, targets), strict=True):
        under = sum(r[3] for r in rows if (*r[:3], 0.5) < cut)
        assert abs(under - wanted) == min(abs(b - wanted) for _, b in edges)


def test_copies_share_a_shard_unless_a_cut_must_run_through_them(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same passage in a third of all rows").otherwise(
            F.concat(F.lit("another passage, copied eight times: "), (F.col("id") % 333).cast("string"))
        ).alias("text"),
    )
    rows = collected(docs, 6, tolerance=0.02)
    check_numbered(rows, 6)
    found = bytes_per(rows, 6)
    assert max(found) - min(found) <= 0.05 * sum(found) / 6
    spread = defaultdict(set)
    for _, text, _, shard, _ in rows:
        spread[text].add(shard)
    assert len(spread.pop("the same passage in a third of all rows")) >= 2
    assert sum(len(s) > 1 for s in spread.values()) <= 4


def test_rows_that_repeat_whole_are_dealt_in_proportion(spark):
    docs = spark.range(6000).select(
        F.when(F.col("id") < 4000, None).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 4000, "one text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
    )
    rows = collected(docs, 8)
    assert len(rows) == 6000
    check_numbered(rows, 8)
    found = bytes_per(rows, 8)
    assert max(found) - min(found) <= 0.25 * sum(found) / 8


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_odd_rows(odd_documents, shards):
    rows = collected(odd_documents, shards)
    assert len(rows) == odd_documents.count()
    check_numbered(rows, shards)
    assert sharding.shard(odd_documents, shards).select("row.*").columns == odd_documents.columns


def test_few_and_no_rows(spark, documents, no_documents):
    assert collected(no_documents, 24) == []
    few = documents.limit(3)
    rows = collected(few, 24)
    check_numbered(rows, 24)
    assert len({r[3] for r in rows}) == 3


def test_negative_and_large_ids(spark):
    ids = [-(1 << 63), -1, 0, 1, (1 << 32) - 1, 1 << 32, (1 << 63) - 1, None]
    docs = spark.createDataFrame([(i, "same") for i in ids for _ in range(2)], "doc_id long, text string")
    rows = collected(docs, 4)
    check_numbered(rows, 4)
    assert bytes_per(rows, 4) == [48] * 4
    smallest = {s: min((r[0] is not None, r[0] or 0) for r in rows if r[3] == s) for s in range(4)}
    assert [smallest[s] for s in range(4)] == sorted(smallest.values())


def test_reruns_agree(documents):
    assert sorted(collected(documents, 7)) == sorted(collected(documents, 7))


def test_main_path_has_no_python(spark, documents, capsys):
    sharding.shard(documents, 5).explain()
    shown = capsys.readouterr().out
    assert "Python" not in shown and "Arrow" not in shown
