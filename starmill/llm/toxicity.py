"""Toxic spans by a linear-chain conditional random field.

Only documents are labelled, so tokens are labelled first: the words and word fronts that tell
toxic documents from others, share against share, are chosen greedily, each time the one that explains
most toxic documents still without one beyond what chance would give, so words that merely accompany
them are not chosen. In toxic documents the words so marked are the toxic tokens; a toxic document
without any teaches the field nothing. A chain is a line's sentence, at most CHAIN tokens of it at a time; its states are
toxic or not. The field has weights for hashed features of a token, of its neighbours, and for the
transitions, and is fitted by gradient steps on the likelihood of the labelled chains.

Forward-backward marginals of all tokens of a document give its largest marginal, their sum, and
their share; a logistic function of these, fitted on the labelled sample, is the score. Tokens
with a marginal of at least one half, runs of them joined, are the offending spans, in code points.

Learning uses at most `train_rows` labelled documents (those with the smallest hash of the id, one row
of each), a bounded number of chains of each, and about `train_tokens` tokens of these (the chains with
the smallest hashes); scoring covers every token of every document. Null text counts as empty; a text
without words has the score of no marginal at all. Rows with a null label are not learned from. If only
one label occurs, or none, or no word tells the labels apart, every score is 0. Repeated rows give
repeated rows, an empty table an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import slices, text_of
from starmill.llm.quality import sample
from starmill.session import materialise

CUT = 0.3
TRAIN_ROWS = 20_000
#: Tokens that the field learns from, about; they are all that the driver holds of the sample.
TRAIN_TOKENS = 1_000_000
#: Words and fronts that may mark a document, at most, by the number of toxic documents they occur in,
#: and how many times rarer they must be in other documents, share against share.
CANDIDATES, RARER = 4_000, 8
#: Lengths of fronts that a word is seen by.
FRONTS = range(3, 9)
#: Tokens of a chain, at most; a longer sentence is several chains.
CHAIN = 256
#: Chains of a labelled document that are learned from: with a toxic token, and without.
TOXIC_CHAINS, OTHER_CHAINS = 8, 4
FEATURE_BITS = 18
#: Characters of a core that are hashed one by one; a longer core's checksum stands for the rest.
SPELLED = 48
#: Words whose weights a worker keeps; the table starts anew when it is full.
TABLE_WORDS = 400_000
EDGE = ".,;:!?\"'()[]{}<>*&%$#|-_=+/\\~`^"


def core(word: str) -> str:
    return word.strip(EDGE).lower()


def marks_of(c: str) -> list[str]:
    """What may mark a document that has this core: itself, and its fronts with `+` for what follows."""
    return [c, *(c[:k] + "+" for k in FRONTS if k < len(c))] if c else []


def chains(text: str) -> tuple[list[str], list[int]]:
    """The words of a text, and the number of words before the end of each chain."""
    words: list[str] = []
    ends: list[int] = []
    for line in text.split("\n"):
        start = len(words)
        words += line.split()
        for at in range(start, len(words)):
            if words[at][-1] in ".!?" or at - start == CHAIN - 1:
                ends.append(at + 1)
                start = at + 1
        if start < len(words):
            ends.append(len(words))
    return words, ends


def _bucket(key: np.ndarray, kind: int) -> np.ndarray:
    mixed = (key ^ np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype("int64")


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per word the buckets of its own features (core, the core's fronts and end, form, and one that
    all words have), and of those that it gives its right and its left neighbour."""
    cores = [core(w) for w in words]
    length = np.fromiter(map(len, cores), "int64", len(cores))
    flat = np.frombuffer("".join(cores).encode("utf-32-le", "surrogatepass"), "uint32").astype("uint64")
    starts = np.cumsum(length) - length
    flat = np.concatenate([flat, np.zeros(1, "uint64")])
    key = np.full(len(cores), 0xCBF29CE484222325, "uint64")
    fronts = []
    seen = min(int(length.max(initial=0)), SPELLED)
    for j in range(max(seen, max(FRONTS))):
        more = j < length
        char = flat[np.minimum(starts + j, len(flat) - 1)]
        key = np.where(more, (key ^ char) * np.uint64(0x100000001B3), key)
        if j + 1 in FRONTS:
            fronts.append(key)
    for n in np.flatnonzero(length > SPELLED).tolist():
        key[n] ^= np.uint64(zlib.crc32(cores[n].encode("utf-8", "surrogatepass")))
    end = np.zeros(len(cores), "uint64")
    for back in (3, 2, 1):
        has = length >= back
        end = end * np.uint64(0x110000) + np.where(has, flat[np.where(has, starts + length - back, 0)], 0)
    forms = [(w.isupper() * 4 + w[:1].isupper() * 2 + w.isalpha()) * 16 for w in words]
    form = np.array(forms, "uint64") + np.minimum(length, 12).astype("uint64")
    always = np.zeros(len(cores), "uint64")
    own = [_bucket(key, 1), *(_bucket(f, 2) for f in fronts), _bucket(end, 3), _bucket(form, 4), _bucket(always, 5)]
    return np.stack(own, 1), np.stack([_bucket(key, 6), _bucket(key, 7)], 1)


def forward_backward(emission: np.ndarray, ends: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds that forward and backward messages give each token, over all chains at once.

    `emission` is the score of toxic over not toxic per token of the flattened chains, `ends` the
    end of each chain, `moves[i, j]` the score of state j after state i. Chains stand by length, so
    each step handles those that are still running.
    """
    starts = np.r_[0, ends[:-1]]
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    starts, length = starts[order], length[order]
    running = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), side="right")
    forward, backward = emission.astype("float64").copy(), np.zeros(len(emission))
    for t in range(1, len(running)):
        at = starts[: running[t]] + t
        f = forward[at - 1]
        forward[at] += np.logaddexp(f + moves[1, 1], moves[0, 1]) - np.logaddexp(f + moves[1, 0], moves[0, 0])
    for t in range(len(running) - 1, 0, -1):
        at = starts[: running[t]] + t
        b = emission[at] + backward[at]
        backward[at - 1] = np.logaddexp(b + moves[1, 1], moves[1, 0]) - np.logaddexp(b + moves[0, 1], moves[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Field:
    """Weights of features and moves, and of the document score."""

    weights: np.ndarray
    moves: np.ndarray
    document: np.ndarray

    def __post_init__(self) -> None:
        self._new_table()

    def _new_table(self) -> None:
        self.index: dict[str, int] = {}
        self.parts = np.zeros((1 << 12, 3))

    def __getstate__(self) -> tuple:
        return self.weights, self.moves, self.document

    def __setstate__(self, state: tuple) -> None:
        self.weights, self.moves, self.document = state
        self._new_table()

    def _learn(self, words: set[str]) -> None:
        if len(self.index) + len(words) > TABLE_WORDS:
            self._new_table()
        need = len(self.index) + len(words)
        if need > len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros((max(need, 2 * len(self.parts)) - len(self.parts), 3))])
        new = list(words)
        own, context = word_features(new)
        self.parts[len(self.index) : need, 0] = self.weights[own].sum(1)
        self.parts[len(self.index) : need, 1:] = self.weights[context]
        self.index.update(zip(new, range(len(self.index), need)))

    def marginals(self, words: list[str], ends: np.ndarray) -> np.ndarray:
        """Probability of each token to be toxic; words of all chains, flattened."""
        distinct = set(words)
        new = distinct - self.index.keys()
        if new:
            self._learn(distinct if len(self.index) + len(new) > TABLE_WORDS else new)
        code = np.fromiter(map(self.index.__getitem__, words), "int32", len(words))
        emission = self.parts[code, 0]
        inner = np.ones(len(words), bool)
        inner[np.r_[0, ends[:-1]]] = False  # first tokens have no left neighbour in their chain
        follow = np.flatnonzero(inner)
        emission[follow] += self.parts[code[follow - 1], 1]
        emission[follow - 1] += self.parts[code[follow], 2]
        forward, backward = forward_backward(emission, ends, self.moves)
        return _sigmoid(forward + backward)

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per text the aggregates of its marginals, and the numbers of its toxic words."""
        words: list[str] = []
        ends: list[int] = []
        bounds = [0]
        for text in texts:
            own, own_ends = chains(text)
            ends += [e + bounds[-1] for e in own_ends]
            words += own
            bounds.append(len(words))
        p = self.marginals(words, np.array(ends, "int64")) if words else np.zeros(0)
        rows, toxic = [], []
        for a, b in zip(bounds, bounds[1:]):
            part = p[a:b]
            rows.append(aggregates(part))
            toxic.append(np.flatnonzero(part >= 0.5))
        return np.array(rows).reshape(-1, 4), toxic

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(rows @ self.document)


def aggregates(p: np.ndarray) -> tuple[float, float, float, float]:
    """One, the largest marginal on a log-odds scale, their sum on a log scale, their share on a root scale."""
    if not len(p):
        return 1.0, -8.0, 0.0, 0.0
    most, total = float(p.max()), float(p.sum())
    odds = np.log(max(most, 1e-12) / max(1 - most, 1e-12))
    return 1.0, float(np.clip(odds, -8, 8)), float(np.log1p(total)), float(np.sqrt(total / len(p)))


def spans(text: str, toxic: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the words with these numbers, neighbours joined."""
    wanted, out, last = set(toxic.tolist()), [], -2
    for n, m in enumerate(re.finditer(r"\S+", text)):
        if n in wanted:
            if n == last + 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            last = n
    return out


def markers(toxic_docs: dict[int, set[str]], cost: dict[str, float] | None = None) -> list[str]:
    """Marks that explain the documents, most explaining first, until none explains two more.

    From the documents that a mark explains, its cost is taken; a mark must explain more than it costs.
    """
    left, out = dict(toxic_docs), []
    while left:
        counts = Counter(w for words in left.values() for w in words)
        gains = {w: n - (cost or {}).get(w, 0) for w, n in counts.items() if n > 1}
        if not gains:
            break
        word, gain = min(gains.items(), key=lambda x: (-x[1], x[0]))
        if gain <= 0:
            break
        out.append(word)
        left = {d: words for d, words in left.items() if word not in words}
    return out


def _cover(rows: DataFrame) -> list[str]:
    """The marks of a labelled sample `doc_id`, `text`, `label`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in slices(batches):
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                by[label > 0].update({m for c in {core(w) for w in text.split()} for m in marks_of(c)})
        for toxic, counts in by.items():
            if counts:
                words, many = zip(*counts.items())
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(many, pa.int64()), pa.array([toxic] * len(words))], ["word", "n", "toxic"])

    counts = rows.mapInArrow(count, "word string, n long, toxic boolean")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    both = counts.groupBy("word").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("other"),
    )
    # toxic documents that would hold it if it were as frequent in them as in others
    cost = (F.col("other") + 1) * (sizes[True] / (sizes[False] + 1))
    telling = both.select("word", "toxic", cost.alias("cost")).where((F.col("toxic") >= 2) & (F.col("cost") * RARER <= F.col("toxic")))
    words = {r["word"]: r["cost"] for r in telling.orderBy(F.desc("toxic"), "word").limit(CANDIDATES).collect()}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            have = [
                sorted({m for c in {core(w) for w in t.split()} for m in marks_of(c) if m in words})
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(have, pa.list_(pa.string()))], ["doc_id", "words"])

    toxic = rows.where("label > 0").mapInArrow(found, "doc_id long, words array<string>")
    return markers({n: set(r["words"]) for n, r in enumerate(toxic.orderBy("doc_id", "words").collect())}, words)


def _labelled_chains(rows: DataFrame, marks: set[str], train_tokens: int = TRAIN_TOKENS) -> list[tuple[list[str], list[bool]]]:
    """Chains of the sample with a label per token; a bounded number per document, chosen by hash, and
    of these the share that holds about `train_tokens` tokens, by hash too.

    A toxic document without any mark gives none: which of its tokens are toxic is not known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple[list[str], list[bool]]] = []
            ids: list[int | None] = []
            for doc_id, text, label in zip(*(column.to_pylist() for column in batch.columns)):
                words, ends = chains(text)
                cut = [words[a:b] for a, b in zip([0, *ends], ends)]
                tagged = [(c, [label > 0 and not marks.isdisjoint(marks_of(core(w))) for w in c]) for c in cut]
                if label > 0 and not any(any(tags) for _, tags in tagged):
                    continue
                tagged.sort(key=lambda x: (zlib.crc32(" ".join(x[0]).encode("utf-8", "surrogatepass")), x[0]))
                out += [x for x in tagged if any(x[1])][:TOXIC_CHAINS] + [x for x in tagged if not any(x[1])][:OTHER_CHAINS]
                ids += [doc_id] * (len(out) - len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([x[0] for x in out], pa.list_(pa.string())), pa.array([x[1] for x in out], pa.list_(pa.bool_()))],
                ["doc_id", "words", "toxic"],
            )

    found = rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, words array<string>, toxic array<boolean>")
    found = materialise(found, "toxic-chains")
    tokens = found.agg(F.sum(F.size("words"))).first()[0] or 0
    if tokens > train_tokens:
        found = found.where(F.pmod(F.xxhash64("doc_id", "words"), F.lit(1 << 30)) < int((1 << 30) * train_tokens / tokens))
    same: dict[str, str] = {}
    out = []
    for batch in found.select("words", "toxic").toArrow().to_batches(max_chunksize=4096):
        for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out.append(([same.setdefault(w, w) for w in words], toxic))  # a word's text is held once
    return sorted(out)


def fit(labelled: list[tuple[list[str], list[bool]]], rounds: int = 60, ridge: float = 1e-6, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and moves that make the labelled chains likely, by scaled gradient steps."""
    words = [w for chain, _ in labelled for w in chain]
    truth = np.array([t for _, tags in labelled for t in tags], "float64")
    ends = np.cumsum([len(chain) for chain, _ in labelled])
    first = np.r_[0, ends[:-1]]
    names = {w: n for n, w in enumerate(dict.fromkeys(words))}
    own, context = word_features(list(names))
    code = np.fromiter(map(names.__getitem__, words), "int64", len(words))
    inner = np.ones(len(words), bool)
    inner[first] = False
    follow = np.flatnonzero(inner)
    size = 1 << FEATURE_BITS
    weights, moves = np.zeros(size), np.zeros((2, 2))
    seen, seen_moves = np.full(size, 1e-8), np.full((2, 2), 1e-8)
    hard = truth.astype(int)
    real = np.zeros((2, 2))
    np.add.at(real, (hard[follow - 1], hard[follow]), 1)
    for _ in range(rounds):
        emission = weights[own].sum(1)[code]
        emission[follow] += weights[context[code[follow - 1], 0]]
        emission[follow - 1] += weights[context[code[follow], 1]]
        forward, backward = forward_backward(emission, ends, moves)
        miss = (truth - _sigmoid(forward + backward)) / len(ends)
        per_word = np.bincount(code, miss, len(names))
        slope = -ridge * weights
        for column in own.T:
            slope += np.bincount(column, per_word, size)
        slope += np.bincount(context[code[follow - 1], 0], miss[follow], size)
        slope += np.bincount(context[code[follow], 1], miss[follow - 1], size)
        f, b = forward[follow - 1], emission[follow] + backward[follow]
        four = np.stack([np.zeros(len(f)) + moves[0, 0], b + moves[0, 1], f + moves[1, 0], f + b + moves[1, 1]])
        four = np.exp(four - four.max(0))
        expected = (four / four.sum(0)).sum(1).reshape(2, 2)
        slope_moves = (real - expected) / len(ends) - ridge * moves
        seen += slope**2
        seen_moves += slope_moves**2
        weights += rate * slope / np.sqrt(seen)
        moves += rate * slope_moves / np.sqrt(seen_moves)
    return weights, moves


def fit_document(rows: np.ndarray, truth: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic weights of the aggregates, by Newton steps."""
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = _sigmoid(rows @ w)
        slope = rows.T @ (truth - p) - ridge * w
        curve = (rows.T * np.maximum(p * (1 - p), 1e-6)) @ rows + ridge * np.eye(len(w))
        w += np.clip(np.linalg.solve(curve, slope), -2, 2)
    return w


def learn(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", train_rows: int = TRAIN_ROWS, **names: str) -> Field | None:
    """A field from the labelled sample; None if it holds one label only."""
    rows = sample(docs, labels, label, train, train_rows, **names)
    rows = materialise(rows.select(F.col("doc_id").cast("long"), "text", "label"), "toxic-sample")
    kinds = {r["toxic"] for r in rows.select((F.col("label") > 0).alias("toxic")).distinct().collect()}
    marks = set(_cover(rows)) if len(kinds) == 2 else set()
    if not marks:
        return None
    field = Field(*fit(_labelled_chains(rows, marks)), np.zeros(4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = field.tag(batch.column(1).to_pylist())[0]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column(2)], ["a", "b", "c", "d", "label"])

    got = rows.mapInArrow(run, "a double, b double, c double, d double, label int").toPandas()
    got = got.sort_values(list(got.columns))
    field.document = fit_document(got[["a", "b", "c", "d"]].to_numpy(), (got["label"] > 0).to_numpy("float64"))
    return field


def tag(docs: DataFrame, field: Field | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, `score`, and `spans`: start and end of the toxic spans of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shared.value
        for batch in slices(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if have:
                rows, toxic = have.tag(texts)
                scores = have.score(rows)
                found = [[{"start": a, "end": b} for a, b in spans(t, x)] if len(x) else [] for t, x in zip(texts, toxic)]
            else:
                scores, found = np.zeros(len(texts)), [[] for _ in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores), pa.array(found, kind)], [*keep, "score", "spans"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "score double", "spans array<struct<start:int,end:int>>"]))
