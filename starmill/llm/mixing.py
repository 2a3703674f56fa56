"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources get targets by weight, each at most `most_repeats` times the source's size; the excess goes
to the others by weight. A source's documents are dealt into blocks by a hash. Its target is an
exact quota of block draws: whole epochs of all its blocks, then blocks of one more epoch in a
permuted order, the last of them cut at a hash so that the words come nearest the target.

The quotas of all sources are split among the shards by a binary tree: at each node the left half
draws its number of blocks from the node's remaining ones without replacement, so the parts of
every source add up exactly. A shard finds its leaf by walking down from the root with draws seeded
by the node's place, so each task computes its own shards, and a lost task repeats the same draws.
A source has at least BLOCKS_PER_SHARD blocks for each shard as far as its documents suffice, so every
shard gets every such source whatever the size of the mix. Blocks and their sizes stay in tables; the
block in which a target is reached is found by running sums there.
A leaf holds a range of each source's permuted blocks, disjoint from all other leaves'; a shard's
rows are then shuffled locally by a hash.

Sizes are numbers of words. Null text has size 0; a null source is a source of its own, after all
others. Documents of size 0 ride with their block. Sources without words have target 0 and nothing
of them is taken. Repeated rows fall into one block and are taken alike. An empty table gives an
empty mix. Columns of the input cannot clash: rows travel in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import boxed
from starmill.session import materialise

#: More sources than this are refused: targets and quotas of sources travel with the tasks.
MOST_SOURCES = 100_000
#: All sources together have about so many blocks, or so many of each source for each shard if that is more.
BLOCKS, BLOCKS_PER_SHARD = 131_072, 64
#: Documents of a block, at least, where the source has them; and blocks of a source, so that products of two fit a long.
DOCS_PER_BLOCK, LARGEST = 16, (1 << 31) - 1
#: Up to so many blocks their draws are broadcast; beyond that documents meet them in a shuffled join.
BROADCAST_BLOCKS = 1 << 18
#: Ranges of a source's permuted blocks that are summed first.
RANGES = 4096
#: Where the caller names no number of shards: words per shard, and the fewest and most shards.
SHARD_WORDS, SHARDS = 1 << 21, (8, 65_536)
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    """One source: its place, size, target, number of blocks, and what is drawn of it.

    `draws` counts blocks over all epochs; the last of them is cut after the key `cut`.
    """

    place: int
    name: str | None
    size: int
    target: float
    blocks: int
    draws: int = 0
    cut: int | None = None


def targets(sizes: Sequence[int], weights: Sequence[float], most_repeats: float = 3) -> list[float]:
    """Shares of all words by weight; what lies above `most_repeats` sizes goes to the others."""
    out = [0.0] * len(sizes)
    active, left = set(range(len(sizes))), float(sum(sizes))
    while active:
        total = sum(weights[i] for i in active)
        over = sorted(i for i in active if left * weights[i] / total > most_repeats * sizes[i])
        if not over:
            for i in sorted(active):
                out[i] = left * weights[i] / total
            break
        # stopping one only adds to the share of the others, so all that are above stop at once
        for i in over:
            out[i] = float(most_repeats * sizes[i])
        left -= sum(out[i] for i in over)
        active -= set(over)
    return out


@lru_cache(maxsize=1 << 16)
def _step(place: int, epoch: int, blocks: int, seed: int) -> tuple[int, int]:
    """Factor and offset of an epoch's permutation of a source's blocks, the factor prime to their number."""
    draw = np.random.default_rng([seed, place, epoch])
    offset = int(draw.integers(blocks))
    while True:
        factor = int(draw.integers(1, blocks + 1))
        if np.gcd(factor, blocks) == 1:
            return factor, offset


def permuted(place: int, ordinal: int, blocks: int, seed: int) -> int:
    """The block that a source's `ordinal`-th draw takes; each epoch takes every block once."""
    factor, offset = _step(place, ordinal // blocks, blocks, seed)
    return (factor * (ordinal % blocks) + offset) % blocks


def leaf(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First ordinal and number of draws per source in one shard, by walking down the tree."""
    first, have, lo, hi = np.zeros_like(quotas), quotas.copy(), 0, shards
    while hi - lo > 1:
        middle = (lo + hi) // 2
        total = int(have.sum())
        take = total * (middle - lo) // (hi - lo)
        draw = np.random.default_rng([seed, lo, hi])
        left = draw.multivariate_hypergeometric(have, take, method="marginals") if total else have
        if shard < middle:
            have, hi = left, middle
        else:
            first, have, lo = first + left, have - left, middle
    return first, have


def _sized(docs: DataFrame, source: str, text: str, doc_id: str, seed: int) -> DataFrame:
    """`doc_id`, `source`, `size` and `key`, a hash that orders documents; the text is read once, here."""
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        words.cast("long").alias("size"),
        key_of(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed).alias("key"),
    )


def key_of(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), blocks)


def shards_for(words: float) -> int:
    """Shards of a mix of so many words, where the caller names no number."""
    return min(max(int(words) // SHARD_WORDS, SHARDS[0]), SHARDS[1])


def blocks_for(docs: Sequence[int], shards: int) -> list[int]:
    """Blocks per source: of about equal numbers of documents, but enough for every shard to get some of each."""
    whole, total = max(BLOCKS, BLOCKS_PER_SHARD * shards * len(docs)), max(1, sum(docs))
    return [max(1, min(n // DOCS_PER_BLOCK, max(whole * n // total, BLOCKS_PER_SHARD * shards), LARGEST)) for n in docs]


def _sources(sized: DataFrame, weights: Sequence[float], most_repeats: float, shards: int | None) -> tuple[list[Source], int]:
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    rows = totals.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], most_repeats)
    shards = shards_for(sum(goal)) if shards is None else shards
    blocks = blocks_for([r["docs"] for r in rows], shards)
    return [Source(i, r["source"], r["size"], goal[i], blocks[i]) for i, r in enumerate(rows)], shards


def _reached(words: DataFrame, sources: list[Source], seed: int) -> dict[int, tuple[int, int, int]]:
    """Per source its block in which the rest of its target after whole epochs is reached: the block's
    place in the permuted order, its number, and the words before it; a row per source at most.

    `words` has the words of each block. Places come from the inverse permutation; ranges of places are
    summed first, so no task holds a source's blocks.
    """
    rows = []
    for s in sources:
        epochs = int(s.target // s.size) if s.size else 0
        if s.size and s.target > epochs * s.size:
            factor, offset = _step(s.place, epochs, s.blocks, seed)
            rows.append((s.place, s.blocks, pow(factor, -1, s.blocks), offset, s.target - epochs * s.size))
    table = F.broadcast(words.sparkSession.createDataFrame(rows, "place int, blocks long, inverse long, offset long, rest double"))
    at = F.pmod(F.col("inverse") * F.pmod(F.col("block") - F.col("offset"), F.col("blocks")), F.col("blocks"))
    placed = words.join(table, "place").withColumn("at", at)
    placed = placed.withColumn("range", F.floor(F.col("at") * RANGES / F.col("blocks")))

    def crossing(sums: DataFrame, order: str) -> DataFrame:
        upto = F.sum("words").over(Window.partitionBy("place").orderBy(order)) + F.col("earlier")
        found = sums.withColumn("before", upto - F.col("words"))
        return found.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))

    ranges = placed.groupBy("place", "rest", "range").agg(F.sum("words").alias("words")).withColumn("earlier", F.lit(0))
    open_ranges = crossing(ranges, "range").select("place", "range", F.col("before").alias("earlier"))
    # at most one range per source
    inside = placed.join(F.broadcast(open_ranges), ["place", "range"])
    return {r["place"]: (r["at"], r["block"], r["before"]) for r in crossing(inside, "at").select("place", "at", "block", "before").collect()}


def _drawn(sized: DataFrame, sources: list[Source], seed: int) -> list[Source]:
    """The sources with their numbers of draws and cuts.

    Only the one block per source in which the target is reached is looked into: its documents' sizes
    are summed in the order of their keys.
    """
    spark = sized.sparkSession
    places = F.broadcast(spark.createDataFrame([(s.place, s.name, s.blocks) for s in sources], "place int, name string, blocks long"))
    placed = sized.join(places, sized["source"].eqNullSafe(places["name"])).withColumn("block", _block(F.col("key"), F.col("blocks")))
    words = materialise(placed.groupBy("place", "block").agg(F.sum("size").alias("words")), "blocks")
    reached = _reached(words, sources, seed)
    out, open_blocks = [], []
    for s in sources:
        epochs = int(s.target // s.size) if s.size else 0
        rest, draws = s.target - epochs * s.size if s.size else 0.0, epochs * s.blocks
        if s.place in reached:
            at, block, before = reached[s.place]
            draws += at + 1
            open_blocks.append((s.place, block, rest - before))
        elif rest > 0:
            draws += s.blocks
        out.append(Source(s.place, s.name, s.size, s.target, s.blocks, draws))
    if not open_blocks:
        return out
    wanted = F.broadcast(spark.createDataFrame(open_blocks, "place int, block long, goal double"))
    order = Window.partitionBy("place").orderBy("key")
    run = placed.join(wanted, ["place", "block"]).groupBy("place", "key", "goal").agg(F.sum("size").alias("size"))
    run = run.withColumn("far", F.abs(F.sum("size").over(order) - F.col("goal")))
    # nothing of the block may be nearer than its first document
    best = run.groupBy("place", "goal").agg(F.min(F.struct("far", "key")).alias("best"))
    cuts = {r["place"]: (r["best"]["key"] if r["best"]["far"] <= r["goal"] else -(1 << 63)) for r in best.collect()}
    return [Source(s.place, s.name, s.size, s.target, s.blocks, s.draws, cuts.get(s.place)) for s in out]


def _draws(spark: SparkSession, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """One row per drawn block: `place`, `block`, `shard`, `epoch`, and `cut` on a source's last one.

    Each task walks down the tree for its own shards. Rows: at most the draws of all sources.
    """
    quotas = np.array([s.draws for s in sources], "int64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, many = leaf(quotas, shards, shard, seed)
                for n in np.flatnonzero(many).tolist():
                    s, lo, hi = sources[n], int(first[n]), int(first[n] + many[n])
                    while lo < hi:
                        epoch = lo // s.blocks
                        stop = min(hi, (epoch + 1) * s.blocks)
                        factor, offset = _step(s.place, epoch, s.blocks, seed)
                        ordinals = np.arange(lo, stop)
                        block = (factor * (ordinals % s.blocks) + offset) % s.blocks
                        cut = pa.array([s.cut] * len(ordinals), pa.int64(), mask=ordinals != s.draws - 1)
                        same = (pa.array(np.full(len(ordinals), x, "int32")) for x in (s.place, shard, epoch))
                        place, at, of = same
                        yield pa.RecordBatch.from_arrays([place, pa.array(block), at, of, cut], ["place", "block", "shard", "epoch", "cut"])
                        lo = stop

    return spark.range(shards).mapInArrow(run, "place int, block long, shard int, epoch int, cut long")


@dataclass(frozen=True)
class Plan:
    """What a mix takes: `sized` documents, the sources, and the drawn blocks, all written."""

    sized: DataFrame
    sources: list[Source]
    draws: DataFrame
    shards: int
    seed: int

    def source_table(self) -> DataFrame:
        rows = [(s.place, s.name, s.blocks, s.size, s.target) for s in self.sources]
        return self.sized.sparkSession.createDataFrame(rows, "place int, name string, blocks long, source_size long, target double")


def plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most_repeats: float = 3,
    shards: int | None = None,
    seed: int = 7,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> Plan:
    """Decide the mix. Sources in code-point order, null last, take the weights in turn, repeating."""
    sized = materialise(_sized(docs, source, text, doc_id, seed), "sizes")
    found, shards = _sources(sized, weights, most_repeats, shards)
    sources = _drawn(sized, found, seed)
    draws = materialise(_draws(docs.sparkSession, sources, shards, seed), "draws")
    return Plan(sized, sources, draws, shards, seed)


def _draws_of_blocks(mix: Plan) -> DataFrame:
    """Per drawn block its draws as an array, broadcast up to BROADCAST_BLOCKS blocks."""
    draw = F.struct("shard", "epoch", "cut")
    table = mix.draws.groupBy("place", "block").agg(F.sort_array(F.collect_list(draw)).alias("draws"))
    return F.broadcast(table) if sum(s.blocks for s in mix.sources) <= BROADCAST_BLOCKS else table


def _taking(key: Column) -> Column:
    return F.filter("draws", lambda d: d["cut"].isNull() | (key <= d["cut"]))


def taken(mix: Plan) -> DataFrame:
    """Per document `doc_id`, `size`, `source`, `source_size`, `target` and `copies`."""
    table = F.broadcast(mix.source_table())
    rows = mix.sized.join(table, mix.sized["source"].eqNullSafe(table["name"]))
    rows = rows.withColumn("block", _block(F.col("key"), F.col("blocks")))
    found = rows.join(_draws_of_blocks(mix), ["place", "block"], "left")
    copies = F.coalesce(F.size(_taking(F.col("key"))), F.lit(0))
    return found.select("doc_id", "size", "source", "source_size", "target", F.greatest(copies, F.lit(0)).cast("long").alias("copies"))


def mixed(docs: DataFrame, mix: Plan, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of the mix: every column of `docs`, and `shard` unless `docs` has a column of that name,
    in upper or lower case; a row appears once per draw.

    Rows meet their blocks by broadcast and are moved once, to their shards, or twice where the blocks are
    too many for that; within a shard they stand in the order of a hash.
    """
    table = F.broadcast(mix.source_table())
    row = F.col("row")
    rows = boxed(docs).select(
        "row",
        row.getField(source).cast("string").alias("source"),
        key_of(row.getField(doc_id), row.getField(text), mix.seed).alias("key"),
    )
    rows = rows.join(table, rows["source"].eqNullSafe(table["name"]))
    rows = rows.withColumn("block", _block(F.col("key"), F.col("blocks")))
    found = rows.join(_draws_of_blocks(mix), ["place", "block"]).select("row", "key", F.explode(_taking(F.col("key"))).alias("d"))
    order = F.xxhash64(F.lit(mix.seed), F.col("d.epoch"), F.col("key"))
    dealt = found.select("row", F.col("d.shard").alias("shard"), order.alias("order"))
    dealt = dealt.repartitionById(mix.shards, "shard").sortWithinPartitions("shard", "order")
    return dealt.select("row.*", *([] if "shard" in map(str.lower, docs.columns) else ["shard"]))
