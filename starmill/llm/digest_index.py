"""Exact deduplication against a persistent index of digests.

The index is a table bucketed by digest, its files sorted by digest: `digest`, `keep_id` (the doc_id
of the row that stays, the largest in its batch), `group_size` (rows of its batch) and the `batch`
that brought the entry; later batches leave an entry as it is, since its row has been kept. A new
batch is reduced to one row per digest (combined before the shuffle, so a group of copies is a few
rows by then), held against the index by a sort-merge anti-join that shuffles the batch alone, and
what is new is appended. The text itself is never shuffled.

Of equal texts in a batch the row with the largest doc_id stays; a null doc_id is smaller than any
other. Texts the index knows from another batch are dropped. A batch may be repeated under its
number until its output is safe: only its own missing entries are appended, so the same rows stay as in
the first run, wherever that failed. Without a number a batch is a new one, numbered after the largest
stored. Different batches need different numbers. Null text counts as empty. Of rows that repeat both doc_id and
text one stays in `keep`, and all carry the same values in `decide`. An empty batch changes nothing.
Columns of the input cannot clash: rows travel in one struct.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import boxed, named_id, pick, text_of, unboxed
from starmill.session import materialise, scratch_path

#: A digest with more than one in so many rows is joined by broadcast; there are fewer than so many of these.
HOT_SHARE = 1024

SCHEMA = "digest binary, keep_id bigint, group_size bigint, batch bigint"


def digest_of(text: str = "text"):
    return F.unhex(F.sha2(text_of(text), 256))


class DigestIndex:
    """The index in a folder that all executors share.

    `buckets` is fixed when the index is made; give it so that one bucket of the expected index
    fits a task comfortably (an entry takes about 60 bytes). Opening a folder that holds an index
    goes on from it, whatever application wrote it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({SCHEMA}) USING parquet OPTIONS (path '{path}') "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )

    def entries(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def number(self, batch: int | None = None) -> int:
        """The number of a batch: the one given, or the next."""
        if batch is not None:
            return batch
        last = self.entries().agg(F.max("batch")).first()[0]
        return 0 if last is None else last + 1

    def add(self, groups: DataFrame, batch: int | None = None) -> int:
        """Append the groups of a batch (`digest`, `keep_id`, `group_size`) whose digest is new; its number.

        The batch is dealt out as the index is, so the anti-join moves neither side again and each
        task appends to one bucket. Entries that an earlier, failed run of the batch appended are
        known by now, so a repeated run appends the others.
        """
        batch = self.number(batch)
        new = groups.repartition(self.buckets, "digest").join(self.entries().hint("merge"), "digest", "left_anti")
        rows = new.select("digest", "keep_id", "group_size", F.lit(batch).cast("long").alias("batch"))
        rows.write.format("parquet").option("path", self.path).bucketBy(self.buckets, "digest").sortBy("digest").mode(
            "append"
        ).saveAsTable(self.table)
        return batch


    def compacted(self, path: str) -> DigestIndex:
        """The same index in the new folder `path`, one sorted file per bucket.

        Every batch adds files to the buckets; a join then sorts each bucket anew. With one file per bucket,
        and `spark.sql.legacy.bucketedTableScan.outputOrdering` set, it reads them in their order.
        """
        other = DigestIndex(self.spark, path, self.buckets)
        # read as plain files: a scan by buckets would stand in for the exchange, and then be given up
        rows = self.spark.read.schema(SCHEMA).parquet(self.path).repartition(self.buckets, "digest")
        rows.write.format("parquet").option("path", path).bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(
            other.table
        )
        return other


def groups_of(digests: DataFrame) -> DataFrame:
    """One row per digest; counted and reduced before the shuffle."""
    return digests.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _with_entry(digests: DataFrame, groups: DataFrame, entries: DataFrame, total: int) -> DataFrame:
    """`digests` with the index entry of each; a digest that holds many rows is not shuffled.

    At most HOT_SHARE digests can hold more than one in HOT_SHARE rows, so these entries are
    broadcast; all other rows meet their entry in a shuffle in which no key is large.
    """
    hot = groups.where(F.col("group_size") > total / HOT_SHARE).select("digest")
    hot_entries = entries.join(F.broadcast(hot), "digest", "left_semi")
    mine = digests.join(F.broadcast(hot), "digest", "left_semi").join(F.broadcast(hot_entries), "digest")
    rest = digests.join(F.broadcast(hot), "digest", "left_anti").join(entries.hint("merge"), "digest")
    return mine.unionByName(rest)


def decide(docs: DataFrame, index: DigestIndex, batch: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `digest`, `keep_id`, `group_size`, `kept`; the index grows.

    The texts are read once, for their digests; those are written, and all else reads them. Give `batch` a
    number to be able to repeat a batch whose output was lost.
    """
    rows = pick(docs, doc_id, text).select("doc_id", digest_of().alias("digest"))
    digests = materialise(rows, "digests")
    groups = materialise(groups_of(digests), "digest-groups")
    batch = index.add(groups, batch)
    total = digests.count()
    found = _with_entry(digests, groups, index.entries().withColumnRenamed("batch", "seen"), total)
    mine = F.col("seen") == F.lit(batch).cast("long")
    return found.select("doc_id", "digest", "keep_id", "group_size", (mine & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"))


def keep(docs: DataFrame, index: DigestIndex, batch: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    What is dropped is far less than what stays in most corpora, but neither is bounded, so rows
    meet their decision in a shuffle by doc_id and digest; copies under other ids have other keys.
    """
    named, keys = named_id(F.col("doc_id")), ["id", "no_id", "digest"]
    stay = decide(docs, index, batch, doc_id, text).where("kept").select(*named, "digest").distinct()
    row = F.col("row")
    digest = F.unhex(F.sha2(F.coalesce(row.getField(text).cast("string"), F.lit("")), 256)).alias("digest")
    rows = boxed(docs).select("row", *named_id(row.getField(doc_id)), digest)
    return unboxed(rows.join(stay, keys, "left_semi").dropDuplicates(keys))


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"))
