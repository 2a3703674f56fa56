"""Document fingerprints that add up over paragraphs.

A homomorphic multiset hash: each paragraph (line) is hashed to a wide vector of 32-bit lanes, and
a document's fingerprint is the sum of its paragraphs' vectors modulo 2 to the 32. The order of
paragraphs does not matter; adding or removing a paragraph adds or subtracts its vector, without
the rest of the text.

The vector has two parts. The first EQUAL lanes are a cryptographic hash of the paragraph: texts
with the same multiset of paragraphs have equal sums, and different ones differ in practice. The
other NEAR lanes are a sketch of the paragraph's character runs, each adding 1 or -1 to one lane; sums of them
estimate inner products of run counts, so the likeness of two documents is the estimated share of the
larger one's runs (by square norm) that the other has too, between 0 and 1; 1 if the first parts
are equal.

`with_neighbours` walks documents in the order of their ids. Ids are dealt into ranges whose bounds
are quantiles, as many as the session has shuffle partitions; each range also gets the first document
of the next one, so a text moves once. Null text counts as empty. A row with a null doc_id has no
place in the order: its next text is empty. Rows that share a doc_id are ordered by text. Repeated
rows give repeated rows, an empty table an empty result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import pick, slices

EQUAL, NEAR = 32, 128
LANES = EQUAL + NEAR
#: Characters in a run; runs at a paragraph's end are shorter.
RUN = 8
#: Characters sketched at once, whatever a text's length.
CHUNK = 1 << 20
LINE_FEED = 10


def _sketch(text: str) -> np.ndarray:
    """Sum over all paragraphs of the sketch of their character runs, one run per character."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "uint32")
    out = np.zeros(2 * NEAR, "int64")
    for at in range(0, len(chars), CHUNK):
        part = chars[at : at + CHUNK + RUN - 1]
        n = min(CHUNK, len(chars) - at)
        part = np.concatenate([part, np.full(n + RUN - 1 - len(part), LINE_FEED, "uint32")])
        value = np.where(part == LINE_FEED, 0, part + np.uint32(1)).astype("uint64")
        key = value[:n].copy()
        inside = value[:n] != 0
        for i in range(1, RUN):
            inside = inside & (value[i : n + i] != 0)
            key = key * np.uint64(0x100000001B3) + value[i : n + i] * inside
        key = key[value[:n] != 0]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        out += np.bincount((key >> np.uint64(64 - 8)).astype("int64"), minlength=2 * NEAR)
    return out[0::2] - out[1::2]


def fingerprint(text: str) -> np.ndarray:
    """The sum of the paragraphs' vectors, as unsigned 32-bit lanes."""
    out = np.zeros(LANES, "uint32")
    paragraphs = text.encode("utf-8", "surrogatepass").split(b"\n")
    digests = b"".join(hashlib.shake_128(p).digest(4 * EQUAL) for p in paragraphs)
    out[:EQUAL] = np.frombuffer(digests, "<u4").reshape(-1, EQUAL).sum(0, dtype="uint32")
    out[EQUAL:] = _sketch(text).astype("uint32")
    return out


def insert(total: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint with one paragraph more."""
    return total + fingerprint(paragraph)


def delete(total: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint with one paragraph less."""
    return total - fingerprint(paragraph)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the larger document's runs that both have."""
    if np.array_equal(a[:EQUAL], b[:EQUAL]):
        return 1.0
    x, y = (v[EQUAL:].view("int32").astype("float64") for v in (a, b))
    most = max(x @ x, y @ y)
    return float(min(max(x @ y / most, 0.0), 1.0)) if most else 0.0


def shown(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `fingerprint` (the lanes as 4-byte numbers, least byte first) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [fingerprint(t).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "fingerprint"])

    rows = pick(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint binary")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_of(bounds: list[int]):
    """Number of the range an id falls into, by binary search in at most a few thousand bounds."""

    def search(ids: pa.Array) -> pa.Array:
        found = np.searchsorted(np.array(bounds, "int64"), ids.to_numpy(zero_copy_only=False), side="right")
        return pa.array(found.astype("int32"))

    return F.arrow_udf(search, "int")


def _dealt(docs: DataFrame) -> DataFrame:
    """`range`, `border`, `doc_id`, `text`: every document in its range, and once more, as the border,
    at the end of the range before if it is the first of its own; the very first document at the end of all."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    cuts = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", cuts, 20 * parts).alias("cuts")).first()["cuts"] if cuts else []
    of = _range_of(sorted(set(found or [])))
    firsts = ids.withColumn("range", of("doc_id")).groupBy("range").agg(F.min("doc_id").alias("first")).collect()
    firsts = sorted((r["range"], r["first"]) for r in firsts)
    # as many rows as there are ranges
    before = [(first, firsts[n - 1][0]) for n, (_, first) in enumerate(firsts)]
    table = F.broadcast(spark.createDataFrame(before, "first long, before int"))
    own = F.struct(of("doc_id").alias("range"), F.lit(0).alias("border"))
    rows = docs.withColumn("own", own).join(table, F.col("doc_id") == F.col("first"), "left")
    extra = F.struct(F.col("before").alias("range"), F.lit(1).alias("border"))
    places = F.when(F.col("before").isNull(), F.array("own")).otherwise(F.array(F.col("own"), extra))
    return rows.select("doc_id", "text", F.explode(places).alias("p")).select("p.range", "p.border", "doc_id", "text")


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, `n_chars`, its fingerprint, the edited text's digest and fingerprint, and likenesses."""
    rows = pick(docs, doc_id, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def out(made: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)

    def compare(key: int | None, text: str, own: np.ndarray, following: str, after: np.ndarray) -> tuple:
        changed = edited(text, following)
        print_ = own if changed == text else fingerprint(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return key, len(text), sha, shown(own), shown(print_), likeness(own, print_), likeness(own, after)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row that waits for its next: range, id, text, fingerprint
        for batch in slices(batches, 256):
            made = []
            for part, border, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if border and (last is None or last[0] != part):
                    continue  # the border has been used: a further row with its id
                own = fingerprint(text)
                if last is not None and last[0] == part:
                    made.append(compare(*last[1:], text, own))
                last = None if border else (part, key, text, own)
            if made:
                yield out(made)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = fingerprint("")
        for batch in slices(batches, 256):
            yield out([compare(None, t, fingerprint(t), "", nothing) for t in batch.column(0).to_pylist()])

    dealt = _dealt(rows.where("doc_id is not null"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartitionById(parts, "range").sortWithinPartitions("range", "border", "doc_id", "text")
    placed = dealt.select("range", "border", "doc_id", "text").mapInArrow(walk, schema)
    return placed.unionByName(rows.where("doc_id is null").select("text").mapInArrow(alone, schema))
