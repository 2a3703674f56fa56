"""Shards of near equal bytes by histogram sort.

Documents are ordered by a key of whole numbers: a hash of the text, then the doc_id in two parts.
Equal texts are neighbours, so copies share a shard unless a cut has to run through them. The cuts
between shards are found on the keys alone: every round lays probes into the open intervals of the
key space, counts in the tasks exactly how many bytes lie below each, and goes on inside the bucket
that holds the wanted number, until a probe is within `tolerance` of it or one key remains. An
interval of one hash is refined by doc_id, so a group of copies is cut where it must be. Rows that
agree in hash and doc_id are alike to the order; a cut inside them deals them out in proportion. Only
then are documents exchanged, once, into ranges of keys; a shard is one range, or several where one
would be large for a task, and its rows are numbered from 0 by their place and the sizes of earlier ranges.

A document's size is its text's UTF-8 bytes plus `overhead`, null text counting as empty. Shards
differ by the tolerance, or by about one document where documents are larger than that; a shard may be
empty if documents are few. A null doc_id comes before any other. Rows that repeat are all kept. An
empty table gives an empty result. Columns of the input cannot clash: rows travel in one struct `row`.
Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import boxed
from starmill.session import materialise

WORDS = ("w0", "w1", "w2")
#: Least and largest value of each word of the key; the least of `w1` is that of a null doc_id.
LEAST = (0, -(1 << 31) - 1, 0)
MOST = ((1 << 62) - 1, (1 << 31) - 1, (1 << 32) - 1)
#: How far a cut's bytes may be from the wanted ones, as a share of a shard.
TOLERANCE = 0.0005
#: The same for cuts inside a shard, as a share of a range.
INNER_TOLERANCE = 0.1
#: Most bytes that one task should sort and write, as long as there are no more than MOST_RANGES tasks.
RANGE_BYTES = 256 << 20
MOST_RANGES = 1 << 14
#: Probes of one round, over all open intervals, and least and most in one of them.
PROBES, FEWEST_PROBES, MOST_PROBES = 1 << 17, 16, 1 << 10

#: A place in the key space, and the share of rows with just that key that lie below it.
Cut = tuple[int, int, int, float]


@dataclass(frozen=True)
class Interval:
    """Keys that begin with `prefix` and whose next word is between `low` and `high`; `below` bytes lie under them."""

    prefix: tuple[int, ...]
    low: int
    high: int
    below: int

    @property
    def level(self) -> int:
        return len(self.prefix)

    def first(self) -> tuple[int, ...]:
        return (*self.prefix, self.low, *LEAST[self.level + 1 :])

    def last(self) -> tuple[int, ...]:
        return (*self.prefix, self.high, *MOST[self.level + 1 :])


@dataclass(frozen=True)
class Bucket:
    """What a round counted between two probes: least and largest word, rows, bytes."""

    low: int
    high: int
    rows: int
    size: int


@dataclass(frozen=True)
class Plan:
    """Cuts between `shards` times `parts` ranges, in order, and the bytes of all rows."""

    shards: int
    parts: int
    total: int
    cuts: tuple[Cut, ...]


def key_words(doc_id: Column, text: Column) -> list[Column]:
    number = doc_id.cast("long")
    return [
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("w0"),
        F.coalesce(F.shiftright(number, 32), F.lit(LEAST[1])).cast("long").alias("w1"),
        F.coalesce(number.bitwiseAND(F.lit(MOST[2])), F.lit(0)).cast("long").alias("w2"),
    ]


def size_of(text: Column, overhead: int) -> Column:
    return (F.octet_length(text) + F.lit(overhead)).cast("long")


def _tuples(rows: Sequence[tuple], names: Sequence[str]) -> Column:
    """A literal array of structs."""
    shown = ["named_struct(" + ",".join(f"'{n}',{v!r}{'D' if isinstance(v, float) else 'L'}" for n, v in zip(names, row, strict=True)) + ")" for row in rows]
    return F.expr(f"array({','.join(shown)})")


def _upto(table: Column, count: int, key: Column) -> Column:
    """How many entries of the sorted literal `table` are at most `key`: a binary search."""
    steps = [1 << bit for bit in reversed(range(count.bit_length()))]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at)
    )


def _count(keys: DataFrame, intervals: Sequence[Interval]) -> list[list[Bucket]]:
    """One round: the buckets of every interval that hold rows, in order. Intervals are sorted and apart."""
    probes = min(MOST_PROBES, max(FEWEST_PROBES, PROBES // len(intervals)))
    key = F.struct(*WORDS)
    place = _upto(_tuples([i.first() for i in intervals], WORDS), len(intervals), key)
    ends = _tuples([(*i.last(), i.level, i.low, (i.high - i.low) // probes + 1) for i in intervals], (*WORDS, "level", "low", "step"))
    found = keys.withColumn("place", place).where("place > 0").withColumn("of", F.get(ends, F.col("place") - 1))
    inside = found.where(key <= F.struct(*(F.col(f"of.{w}") for w in WORDS)))
    counted = (
        inside.withColumn("word", F.get(F.array(*WORDS), F.col("of.level")))
        .groupBy("place", F.expr("(word - of.low) div of.step").alias("bucket"))
        .agg(F.min("word").alias("low"), F.max("word").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"))
    )
    out: list[list[Bucket]] = [[] for _ in intervals]
    for row in sorted(counted.collect(), key=lambda r: (r["place"], r["bucket"])):
        out[row["place"] - 1].append(Bucket(row["low"], row["high"], row["rows"], row["size"]))
    return out


def _cut(prefix: tuple[int, ...], word: int) -> Cut:
    """Before every key that begins with `prefix` and has this word or a larger one next."""
    return (*prefix, word, *LEAST[len(prefix) + 1 :], 0.0)


def find_cuts(keys: DataFrame, total: int, targets: Sequence[tuple[float, float]]) -> list[Cut]:
    """For each target (bytes below, bytes it may be off) a cut in the space of `keys` (WORDS and `size`)."""
    best: list[tuple[float, Cut]] = [(float("inf"), (*LEAST, 0.0))] * len(targets)
    waiting = {Interval((), LEAST[0], MOST[0], 0): list(range(len(targets)))} if total else {}
    while waiting:
        intervals = sorted(waiting, key=Interval.first)
        onward: dict[Interval, list[int]] = defaultdict(list)
        for interval, buckets in zip(intervals, _count(keys, intervals), strict=True):
            starts = [interval.below]
            for b in buckets:
                starts.append(starts[-1] + b.size)
            cuts = [_cut(interval.prefix, b.low) for b in buckets] + [_cut(interval.prefix, buckets[-1].high + 1)]
            for t in waiting[interval]:
                wanted, slack = targets[t]
                at = min(max(bisect_right(starts, wanted) - 1, 0), len(buckets) - 1)
                best[t] = min(best[t], *((abs(starts[e] - wanted), cuts[e]) for e in (at, at + 1)))
                held = buckets[at]
                if best[t][0] <= slack or held.rows == 1:
                    continue
                if held.low < held.high:
                    onward[Interval(interval.prefix, held.low, held.high, starts[at])].append(t)
                elif interval.level + 1 < len(WORDS):
                    level = interval.level + 1
                    onward[Interval((*interval.prefix, held.low), LEAST[level], MOST[level], starts[at])].append(t)
                else:
                    share = (wanted - starts[at]) / held.size
                    best[t] = (0.0, (*interval.prefix, held.low, share))
        waiting = onward
    return sorted(cut for _, cut in best)


def plan(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", overhead: int = 8, tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES) -> Plan:
    """Where the shards of `docs` begin. Reads the texts once, for their hashes and sizes."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keys = materialise(docs.select(*key_words(F.col(f"`{doc_id}`"), body), size_of(body, overhead).alias("size")), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(1, min(-(-total // (shards * range_bytes)), MOST_RANGES // shards))
    ranges = shards * parts
    targets = []
    for cut in range(1, ranges):
        slack = tolerance * total / shards if cut % parts == 0 else INNER_TOLERANCE * total / ranges
        targets.append((cut * total / ranges, min(slack, INNER_TOLERANCE * total / ranges)))
    return Plan(shards, parts, total, tuple(find_cuts(keys, total, targets)))


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", overhead: int = 8, tolerance: float = TOLERANCE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All rows of `docs` as `row`, with `size`, `shard` from 0 and `slot`, gapless from 0 in each shard.

    Rows are written in the order of shard and slot; a shard's files hold its rows together.
    """
    made = plan(docs, shards, doc_id, text, overhead, tolerance, range_bytes)
    row = F.col("row")
    body = F.coalesce(row.getField(text).cast("string"), F.lit(""))
    rows = boxed(docs).select("row", *key_words(row.getField(doc_id), body), size_of(body, overhead).alias("size"), F.rand(0).alias("share"))
    if made.cuts:
        names = (*WORDS, "share")
        at = _upto(_tuples(made.cuts, names), len(made.cuts), F.struct(*names))
    else:
        at = F.lit(0)
    dealt = rows.withColumn("range", at).repartitionById(shards * made.parts, "range").sortWithinPartitions("range", *WORDS)
    slot = F.monotonically_increasing_id()
    placed = materialise(dealt.select("row", "size", "range", F.spark_partition_id().alias("part"), slot.alias("at")), "shards")
    # one row per range, of which there are MOST_RANGES at most
    earlier = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("range", "part")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("shard", F.expr(f"CAST(range div {made.parts} AS INT)"))
        .select("range", "part", "shard", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"))
    )
    return placed.join(F.broadcast(offsets), ["range", "part"]).select("row", "size", "shard", (F.col("at") + F.col("offset")).alias("slot"))
