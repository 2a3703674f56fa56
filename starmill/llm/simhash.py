"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position i gets a non-zero vector m(i) of radius + 1 bits. For each non-zero vector v of
that length there is a table whose mask holds the positions with an odd product of m(i) and v. The
vectors of any `radius` positions span less than the whole space, so some v is orthogonal to all of
them and its mask avoids them: two fingerprints within the radius agree on that mask and meet in
that table, always. Links are then checked by exact distance.

Equal fingerprints are reduced to one row first. A bucket of two is compared by built-in
expressions. A larger bucket is linked inside one task as a spanning forest, not as all pairs. A
bucket above BUCKET rows is split, exactly: its free positions (off the mask) fall into radius + 1
classes, and two fingerprints within the radius agree on one class at least; so each row goes to
one bucket per class, and so on with other classes. After the last split at most 2 to the number
of still free positions fingerprints can share a bucket, a fixed bound.

Null and wordless texts have fingerprint zero and are linked like any other. Rows with a null
doc_id take part; a component without any doc_id has a null component_id. Repeated rows give
repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import boxed, named_id, pick, slices, unboxed
from starmill.llm.components import components
from starmill.operators.skew import join_counted
from starmill.session import materialise

BITS = 64
#: Rows of a bucket that one task links at once.
BUCKET = 1024
SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """Bit b is one if it is one in over half of the shingle hashes; repeats count."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    runs = zip(*(parts[i:] for i in range(words))) if len(parts) >= words else [parts]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), "uint64")
    ones = np.zeros(BITS, "int64")
    for start in range(0, len(hashes), 65_536):
        part = hashes[start : start + 65_536]
        bits = np.unpackbits(part.view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype="uint32")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("uint64")[0])


def fingerprints(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `text_hash` and `fp` (the fingerprint as a signed long) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            signed = np.array(made, "uint64").view("int64")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], ["doc_id", "text_hash", "fp"])

    rows = pick(docs, doc_id, text).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def masks(radius: int) -> list[int]:
    """The covering masks, one per non-zero vector of radius + 1 bits."""
    vectors = (1 << (radius + 1)) - 1
    kinds = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(kinds) if (m & v).bit_count() % 2) for v in range(1, vectors + 1)]


def classes(radius: int) -> list[list[int]]:
    """For each further split, masks that deal all positions into radius + 1 classes."""
    n = radius + 1
    splits, step = [], 1
    while step < BITS:
        splits.append([sum(1 << i for i in range(BITS) if i // step % n == j) for j in range(n)])
        step *= n
    return splits


def forest(members: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links (fingerprint, root) that connect what lies within the radius of one another."""
    left = np.sort(members)
    while len(left):
        root, left, frontier = left[0], left[1:], [left[0]]
        while frontier and len(left):
            differing = (left ^ frontier.pop()).view("uint64")  # of a signed number the count is that of its amount
            near = np.bitwise_count(differing) <= radius
            found, left = left[near], left[~near]
            frontier.extend(found)
            for fp in found.tolist():
                yield fp, int(root)


def _linked(groups: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            links = [pair for fps in batch.column(0).to_pylist() for pair in forest(np.array(fps, "int64"), radius)]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("members").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links `a`, `b` that connect all fingerprints (`fp`, each once) within the radius of one another.

    Not every pair within the radius is listed, but any such pair is connected by listed links, and
    every listed link is within one bucket's chain of such pairs.
    """
    tables = [
        F.struct(
            F.xxhash64(F.lit(v), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("g"),
            F.lit(_signed(~m & (1 << BITS) - 1)).alias("free"),
        )
        for v, m in enumerate(masks(radius))
    ]
    rows = distinct.select("fp", F.explode(F.array(*tables)).alias("t")).select("fp", "t.g", "t.free")
    found: list[DataFrame] = []
    splits = classes(radius)
    for n in range(len(splits) + 1):
        rows = materialise(rows, "buckets")
        sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        sizes = materialise(sizes.where("size > 1"), "bucket-sizes")
        pair = (F.col("size") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        found.append(sizes.where(pair).select("a", "b"))
        last = n == len(splits)
        met = join_counted(rows, sizes.where("size > 2").select("g", "size"), ["g"], "size")
        some = met if last else met.where(F.col("size") <= bucket)
        found.append(_linked(some.groupBy("g").agg(F.collect_list("fp").alias("members")), radius))
        if last or sizes.where(F.col("size") > bucket).isEmpty():
            break
        parts = [F.struct(F.lit(j).alias("j"), F.lit(_signed(c)).alias("c"), F.lit(_signed(~c & (1 << BITS) - 1)).alias("d")) for j, c in enumerate(splits[n])]
        rows = met.where(F.col("size") > bucket).select("fp", "g", "free", F.explode(F.array(*parts)).alias("p"))
        rows = rows.select(
            "fp",
            F.xxhash64("g", "p.j", F.expr("fp & free & p.c")).alias("g"),
            F.expr("free & p.d").alias("free"),
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, `text_hash`, `fp`, `root` (names the component) and `component_id`.

    The component holds what is reachable over links of at most `radius` differing bits;
    `component_id` is the smallest doc_id in it.
    """
    marked = materialise(fingerprints(docs, words, doc_id, text), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    distinct = materialise(distinct, "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialise(rooted.select("fp", "least", "size", F.coalesce("root", "fp").alias("root")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    groups = materialise(groups, "component-ids")
    named = join_counted(rooted, groups, ["root"], "members").select("fp", "size", "root", "component_id")
    named = materialise(named, "named")
    return join_counted(marked, named, ["fp"], "size").drop("size")


def keep(docs: DataFrame, words: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each component, with all columns of `docs`.

    A null doc_id is larger than any other; of rows that share the doc_id the one whose text hash
    is smallest stays, and of wholly repeated rows one.
    """
    found = near_duplicates(docs, words, radius, doc_id, text)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    stay = found.groupBy("root").agg(F.min(order).alias("k"))
    row, keys = F.col("row"), ["id", "no_id", "text_hash"]
    stay = stay.select(*named_id(F.col("k.doc_id")), "k.text_hash").distinct()
    text_hash = F.xxhash64(F.coalesce(row.getField(text).cast("string"), F.lit(""))).alias("text_hash")
    rows = boxed(docs).select("row", *named_id(row.getField(doc_id)), text_hash)
    return unboxed(rows.join(stay, keys, "left_semi").dropDuplicates(keys))


def hex16(fp: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
