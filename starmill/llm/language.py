"""Language identification by multinomial naive Bayes over hashed character n-grams.

Text is folded to lower case with every character that is no letter as a space; n-grams of one to
`ORDERS` characters, word ends included, are hashed to buckets. Bucket counts per language come
from at most `train_rows` documents (those with the smallest hash of the id; a parameter), counted
in the tasks and summed by Spark. The matrix of log probabilities is broadcast. A slice of texts is
scored as a sparse matrix in compressed rows times that matrix: bucket rows are gathered and summed
per document. Up to `DENSE_LANGUAGES` the matrix is dense, its size fixed by the number of buckets.
With more languages only buckets that a language was seen with are stored, as what they add to the
language's value for unseen ones; their number is bounded by the n-grams of the sample, and a slice
is scored in blocks of bounded size. Both give the same result; no number of languages is refused.

`lang_pred` is the likeliest learned language (of equal ones the first by code point) and `score`
its posterior probability. A null text, or one without a letter, is `und` with score 0, and so is
every text if no language was learned. Repeated rows give repeated rows, an empty table an empty
result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import slices, text_of

BUCKET_BITS = 15
ORDERS = 3
TRAIN_ROWS = 50_000
#: Most languages whose log probabilities are one dense matrix.
DENSE_LANGUAGES = 128
#: Stored probabilities that are summed at once where the matrix is sparse.
BLOCK = 1 << 21
#: n-grams summed at once, whatever a text's length.
CHUNK = 1 << 19
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For every code point its lower-case letter, or a space."""
    out = np.full(0x110000, 32, "uint32")
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, ORDERS spaces before each and at the end, and where each starts."""
    gap = " " * ORDERS
    whole = gap.join(["", *texts, ""]).encode("utf-32-le", "surrogatepass")
    starts = np.zeros(len(texts) + 1, "int64")
    np.cumsum([len(t) + ORDERS for t in texts], out=starts[1:])
    return _folded()[np.frombuffer(whole, "uint32")], starts


def _buckets(chars: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each character; they look ORDERS - 1 characters ahead."""
    n = len(chars) - ORDERS
    key = np.full(n, order, "uint64")
    for i in range(order):
        key = (key * np.uint64(0x100000001B3)) ^ chars[i : n + i]
    key *= np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(64 - BUCKET_BITS)).astype("int32")


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (number of the text, bucket), in order of the texts; n-grams start at letters or just before a word."""
    chars, starts = _letters(texts)
    for at in range(0, len(chars) - ORDERS, CHUNK):
        part = chars[at : at + CHUNK + ORDERS]
        letter = part != 32
        text = np.searchsorted(starts, np.arange(at, at + len(part) - ORDERS), side="right") - 1
        for order in range(1, ORDERS + 1):
            start = letter[: len(part) - ORDERS] if order == 1 else letter[: len(part) - ORDERS] | letter[1 : len(part) - ORDERS + 1]
            chosen = np.flatnonzero(start)
            yield text[chosen], _buckets(part, order)[chosen]


def _counts(rows: DataFrame, place: dict[str, int]) -> pa.Table:
    """`lang` (its place), `bucket`, `n`: counted in each task and then summed; at most buckets times languages rows."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            by: dict[int, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(place[lang], []).append(text)
            for lang, texts in by.items():
                have = sums.setdefault(lang, np.zeros(size, "int64"))
                for _, buckets in grams(texts):
                    have += np.bincount(buckets, minlength=size)
            # no task holds the sums of very many languages
            if len(sums) > DENSE_LANGUAGES:
                yield from emitted(sums)
                sums = {}
        yield from emitted(sums)

    def emitted(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, have in sums.items():
            used = np.flatnonzero(have)
            columns = [np.full(len(used), lang, "int32"), used.astype("int32"), have[used]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "bucket", "n"])

    counted = rows.select("text", "lang").mapInArrow(run, "lang int, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()


class Model:
    """Learned languages, and the log probability of every bucket and of each language."""

    def __init__(self, counts: pa.Table, documents: dict[str, int], smooth: float = 0.5):
        self.languages = sorted(documents)
        lang, bucket, n = (counts.column(c).to_numpy() for c in ("lang", "bucket", "n"))
        many = np.array([documents[x] for x in self.languages], "float64")
        self.prior = np.log(many / many.sum())
        self._store(lang, bucket, n, smooth)

    def _store(self, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray, smooth: float) -> None:
        cells = np.full((1 << BUCKET_BITS, len(self.languages)), smooth)
        cells[bucket, lang] += n
        self.buckets = np.log(cells / cells.sum(0)).astype("float32")

    def _add(self, total: np.ndarray, text: np.ndarray, buckets: np.ndarray) -> None:
        """Add the log probabilities of n-grams, in order of `text`, to its rows."""
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        total[text[first]] += np.add.reduceat(self.buckets[buckets], first, axis=0, dtype="float64")

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts), bool)
        for text, buckets in grams(texts):
            if len(text):
                self._add(total, text, buckets)
                seen[text] = True
        total += self.prior
        best = total.argmax(1)
        share = np.exp(total - total.max(1, keepdims=True))
        score = np.where(seen, 1 / share.sum(1), 0.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), seen.tolist())], score


class SparseModel(Model):
    """The same for many languages: `unseen` per language, and what seen buckets add, by bucket."""

    def _store(self, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray, smooth: float) -> None:
        sums = np.bincount(lang, n, minlength=len(self.languages)) + smooth * (1 << BUCKET_BITS)
        self.unseen = np.log(smooth / sums)
        order = np.argsort(bucket, kind="stable")
        self.lang, self.more = lang[order].astype("int32"), np.log1p(n[order] / smooth).astype("float32")
        self.start = np.r_[0, np.cumsum(np.bincount(bucket, minlength=1 << BUCKET_BITS))]

    def _add(self, total: np.ndarray, text: np.ndarray, buckets: np.ndarray) -> None:
        total += np.bincount(text, minlength=len(total))[:, None] * self.unseen
        cells, times = np.unique(text.astype("int64") << BUCKET_BITS | buckets, return_counts=True)
        text, buckets = cells >> BUCKET_BITS, cells & (1 << BUCKET_BITS) - 1
        reach = self.start[buckets + 1] - self.start[buckets]
        cuts = np.flatnonzero(np.diff(np.cumsum(reach) // BLOCK)) + 1
        for part in np.split(np.arange(len(cells)), cuts):
            wide = reach[part]
            within = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
            at = np.repeat(self.start[buckets[part]], wide) + within
            place = np.repeat(text[part], wide) * total.shape[1] + self.lang[at]
            first = int(text[part][0]) if len(part) else 0
            last = int(text[part][-1]) + 1 if len(part) else 0
            sums = np.bincount(place - first * total.shape[1], np.repeat(times[part], wide) * self.more[at], (last - first) * total.shape[1])
            total[first:last] += sums.reshape(last - first, -1)


def learn(
    docs: DataFrame,
    train: Column,
    train_rows: int = TRAIN_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model | None:
    """A model from documents with a language for which `train` (of doc_id) holds; None without any.

    Which documents, at most `train_rows`, is decided on ids alone; their texts stay where they are.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & train)
    mark = F.xxhash64("doc_id")
    bound = rows.select(mark.alias("mark")).orderBy("mark").limit(train_rows).agg(F.max("mark")).first()[0]
    if bound is None:
        return None
    chosen = rows.where(mark <= bound)
    # at most one row per document of the sample
    documents = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = _counts(chosen, {lang: i for i, lang in enumerate(sorted(documents))})
    return (Model if len(documents) <= DENSE_LANGUAGES else SparseModel)(counts, documents)


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, `lang_pred` and `score` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shared.value
        for batch in slices(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            langs, scores = have.predict(texts) if have else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "lang_pred string", "score double"]))
