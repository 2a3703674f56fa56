"""Document quality by pairwise ranking.

A Bradley-Terry model learns a weight per text feature from preference pairs: of a document
labelled good and one labelled bad, the good one should score higher. It is fitted by Newton steps
on the logistic loss of feature differences. The threshold is the quantile of the training scores
at the share of bad labels, and the score shown is the logistic function of the distance from it,
placed so that the threshold shows as the documented cut.

Every labelled document is learned from. They are dealt into blocks by a hash of the id, and inside a
block every good one is paired with every bad one; the rarer kind stands in several blocks, so that each
document meets `pairs` of the other kind or all of them. Scales, Newton sums and quantiles are
taken over all rows by tasks; the driver sees one sum per task. What is summed is first rounded to a common
quantum, so no sum depends on an order. Scoring covers every document and its whole text, with
features of the text alone.

Null text counts as empty and is scored like any text. Rows with a null label are not learned
from, of an id in several rows its smallest label and the text with the smallest hash. If only one label
occurs, or none, nothing can be ranked: every score is 0.5. Repeated rows give repeated rows, an
empty table an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import boxed, pick, slices, text_of
from starmill.operators.analytics import percentiles
from starmill.session import materialise

#: Pairs that a fit in memory draws.
PAIRS = 20_000
#: Documents of the other kind that a labelled one meets, about, and documents of the commoner kind in a block.
PARTNERS, BLOCK_ROWS = 64, 256
#: Raw scores are whole multiples of this in the quantiles.
GRAIN = 2.0**-20
#: Shown score at which a document counts as good.
CUT = 0.3

#: Classes of bytes: lower case, upper case, digit, space, line feed, mark of prose, other mark, beyond ASCII, control.
_CLASSES = np.full(256, 8, "uint8")
_CLASSES[128:] = 7
_CLASSES[33:127] = 6
for _chars, _n in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b" ", 3), (b"\n", 4), (b".,;:'\"?-()", 5)):
    _CLASSES[list(_chars)] = _n
#: Bounds of the steps a share is also seen in.
STEPS = (0.003, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7)
SHARES = 13


def shares(text: str) -> list[float]:
    """Shares between 0 and 1 that describe a text, and its length and word length on a log scale."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    words = text.split()
    w = len(words)
    if not w:
        return [0.0] * SHARES + [np.log1p(n), 0.0]
    kinds = np.bincount(_CLASSES[np.frombuffer(raw, "uint8")], minlength=9)
    letters = max(1, kinds[0] + kinds[1])
    lines = [line for line in text.split("\n") if line]
    by_kind = (kinds[[1, 2, 5, 6, 7, 8]] / n).tolist()
    return [
        *by_kind,
        kinds[1] / letters,
        1 - len(set(words)) / w,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(eq, words, words[1:])) / w,
        text.count("!") / n,
        text.count("|") / n,
        kinds[3] / n,
        np.log1p(n),
        np.log1p(n / w),
    ]


def features(texts: list[str]) -> np.ndarray:
    """One row per text: the shares, their roots, the steps they have reached, lengths and squares of these."""
    return expanded(np.array([shares(t) for t in texts], "float64").reshape(len(texts), SHARES + 2))


def expanded(base: np.ndarray) -> np.ndarray:
    part, length = base[:, :SHARES], base[:, SHARES:]
    steps = [part > bound for bound in STEPS]
    return np.hstack([part, np.sqrt(part), *steps, length, length**2])


@dataclass(frozen=True)
class Ranker:
    """Weights for scaled features, and how a raw score is shown."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shown = (self.raw(x) - self.threshold) * self.slope + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shown, -500, 500)))


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, ridge: float, steps: int) -> np.ndarray:
    """Weights where the loss is least; `sums` gives the mean slope and curvature of all pairs at some weights."""
    w = np.zeros(width)
    for _ in range(steps):
        slope, curve = sums(w)
        move = np.linalg.solve(curve + ridge * np.eye(width), slope + ridge * w)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7, ridge: float = 1e-3, steps: int = 12) -> Ranker:
    """A fit in memory: Bradley-Terry weights from random (good, bad) pairs, then the threshold by score quantile."""
    draw = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    first, second = draw.choice(better, pairs), draw.choice(worse, pairs)

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slope, curve = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for at in range(0, pairs, 20_000):
            d = z[first[at : at + 20_000]] - z[second[at : at + 20_000]]
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            slope -= d.T @ p / pairs
            curve += (d.T * (p * (1 - p))) @ d / pairs
        return slope, curve

    w = newton(sums, x.shape[1], ridge, steps)
    raw = z @ w
    low, high = np.quantile(raw, np.clip(np.array([-0.002, 0.002]) + (~good).mean(), 0, 1))
    threshold = float(low + high) / 2
    spread = float(np.median(np.abs(raw - threshold))) or 1.0
    return Ranker(mean, scale, w, threshold, 2 / spread)


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `text` and `label` of at most `rows` labelled documents for which `train` (of doc_id) holds.

    The ids with the smallest hashes are taken, at most `rows`, so they may be broadcast. There is one row
    per id however often it stands in either table: its smallest label, and the text with the smallest hash.
    """
    wanted = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    wanted = wanted.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & train)
    wanted = wanted.groupBy("doc_id").agg(F.min("label").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = pick(docs, doc_id, text).join(F.broadcast(wanted), "doc_id")
    one = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("doc_id", F.col("one.text").alias("text"), "label")


def labelled(docs: DataFrame, labels: DataFrame, label: str, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `good` and `base`, the shares of the text, of every labelled document for which `train` (of doc_id) holds.

    There is one row per id, as in `sample`. Shares are taken before the join, so numbers are shuffled and not texts.
    """
    wanted = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    wanted = wanted.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & train)
    wanted = wanted.groupBy("doc_id").agg(F.min("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base = np.array([shares(t) for t in batch.column(2).to_pylist()], "float64")
            listed = pa.FixedSizeListArray.from_arrays(pa.array(base.ravel()), SHARES + 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], listed.cast(pa.list_(pa.float64()))], ["doc_id", "hash", "base"])

    texts = pick(docs, doc_id, text).where(F.col("doc_id").isNotNull() & train).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    seen = texts.mapInArrow(run, f"doc_id {kind}, hash long, base array<double>")
    one = seen.groupBy("doc_id").agg(F.min(F.struct("hash", "base")).alias("one"))
    return one.join(wanted, "doc_id").select(F.xxhash64("doc_id").alias("key"), (F.col("label") > 0).alias("good"), "one.base")


def blocked(rows: DataFrame, many: dict[bool, int], pairs: int) -> DataFrame:
    """Blocks of `labelled` rows, one row each: a sorted array `docs` of structs `good`, `base`.

    A row of the rarer kind stands in as many neighbouring blocks as it takes for each block to have
    `pairs` of them, about; in all of them, if there are no more than that.
    """
    blocks = -(-max(many.values()) // BLOCK_ROWS)
    copies = {kind: min(blocks, max(1, -(-pairs * blocks // n))) for kind, n in many.items()}
    repeats = F.when(F.col("good"), F.lit(copies[True])).otherwise(F.lit(copies[False]))
    dealt = rows.select("key", "good", "base", F.explode(F.sequence(F.lit(0), repeats - 1)).alias("copy"))
    block = F.pmod(F.pmod(F.col("key"), F.lit(blocks)) + F.col("copy"), F.lit(blocks)).alias("block")
    return dealt.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("good", "base"))).alias("docs"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """The features of rows whose `base` these are."""
    return expanded(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, SHARES + 2))


def _quantum(bound: np.ndarray) -> np.ndarray:
    """A power of two of which numbers that add up to `bound` at most are exact multiples in any sum."""
    return 2.0 ** (np.ceil(np.log2(np.maximum(bound, 1e-200))) - 51)


def _totals(rows: DataFrame, of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], quantum: np.ndarray) -> np.ndarray:
    """The sum of what `of` gives, every term rounded to multiples of `quantum`; a row per task reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(quantum)
        for batch in batches:
            for term in of(batch):
                total += np.round(term / quantum) * quantum
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["total"])

    sums = rows.mapInArrow(run, "total array<double>").toArrow().column("total").combine_chunks()
    return sums.flatten().to_numpy().reshape(-1, *quantum.shape).sum(0)


def _scales(rows: DataFrame, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and largest distance from the mean in scales of every feature over all `rows`."""
    width = features([""]).shape[1]
    most = rows.select(F.array_max("base").alias("most")).agg(F.max("most")).first()[0]
    bound = np.full(width, max(1.0, most) ** 2)
    mean = _totals(rows, lambda b: iter([_matrix(b.column("base")).sum(0)]), _quantum(many * bound)) / many
    squares = _totals(rows, lambda b: iter([((_matrix(b.column("base")) - mean) ** 2).sum(0)]), _quantum(many * bound**2))
    scale = np.sqrt(squares / many)
    scale = np.where(scale > 1e-9, scale, 1.0)
    return mean, scale, np.minimum(bound / scale, np.sqrt(2.0 * many) + 1)


def _block_sums(mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """Per block the sums over all its pairs: slope in the first row, curvature in the others.

    The curvature of all pairs of a block is that of its rows, weighted by their pairs, less the products across.
    """

    def of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for docs in batch.column("docs"):
            good = docs.values.field("good").to_numpy(zero_copy_only=False)
            z = (_matrix(docs.values.field("base")) - mean) / scale
            a, b = z[good], z[~good]
            p = 1 / (1 + np.exp(np.clip((a @ w)[:, None] - (b @ w), -30, 30)))
            q = p * (1 - p)
            across = a.T @ (q @ b)
            curve = (a.T * q.sum(1)) @ a + (b.T * q.sum(0)) @ b - across - across.T
            yield np.vstack([b.T @ p.sum(0) - a.T @ p.sum(1), curve])

    return of


def learn(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", pairs: int = PARTNERS, ridge: float = 1e-3, steps: int = 12, **names: str) -> Ranker | None:
    """A ranker from every labelled document, each in `pairs` pairs at least or in all; None if nothing can be ranked."""
    rows = materialise(labelled(docs, labels, label, train, **names), "labelled")
    many = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(many) < 2:
        return None
    total = sum(many.values())
    mean, scale, far = _scales(rows, total)
    blocks = materialise(blocked(rows, many, pairs), "quality-blocks")
    better = F.size(F.filter("docs", lambda d: d["good"])).cast("long")
    compared = blocks.agg(F.sum(better * (F.size("docs") - better))).first()[0]
    quantum = _quantum(compared * np.vstack([2 * far, np.outer(far, far)]))

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = _totals(blocks, _block_sums(mean, scale, w), quantum) / compared
        return found[0], found[1:]

    w = newton(sums, len(mean), ridge, steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = ((_matrix(batch.column(0)) - mean) / scale) @ w
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(raw / GRAIN).astype("int64"))], ["raw"])

    raw = materialise(rows.select("base").mapInArrow(run, "raw long"), "raw-scores").withColumn("of", F.lit(0))
    bad = many[False] / total
    ends = {"low": max(bad - 0.002, 0.0), "high": min(bad + 0.002, 1.0)}
    cut = percentiles(raw, ["of"], "raw", ends).first()
    threshold = (cut["low"] + cut["high"]) / 2
    off = raw.select("of", F.abs(F.col("raw") - F.lit(threshold)).cast("long").alias("off"))
    spread = percentiles(off, ["of"], "off", {"half": 0.5}).first()["half"] * GRAIN or 1.0
    return Ranker(mean, scale, w, threshold * GRAIN, 2 / spread)


def scores(docs: DataFrame, ranker: Ranker | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep` and `score` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            made = ranker.score(features(texts)) if ranker else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made)], [*keep, "score"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "score double"]))


def keep_good(docs: DataFrame, ranker: Ranker | None, text: str = "text") -> DataFrame:
    """The rows whose score reaches the cut, with all their columns; nothing is shuffled."""

    def score_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts = part.to_pylist()
            made = [
                ranker.score(features(texts[at : at + 512])) if ranker else np.full(len(texts[at : at + 512]), 0.5)
                for at in range(0, len(texts), 512)
            ]
            yield pa.array(np.concatenate(made) if made else np.zeros(0))

    score = F.arrow_udf(score_of, "double")
    rows = boxed(docs)
    whole = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    return rows.where(score(whole) >= CUT).select("row.*")
