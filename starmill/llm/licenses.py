"""Licence notices by a trained paragraph classifier, confirmed against templates.

A paragraph is a line; its tokens are runs of letters and digits in lower case, digits read as 0.
Longer paragraphs are seen through overlapping windows of two blocks of BLOCK tokens. A logistic
regression over hashed word n-grams (one to three words) gives each window shares of the families and `unknown`.
It is trained on the templates, varied by dropping, cutting and surrounding words, against windows
of a bounded sample of the corpus (at most `sample_rows` documents with the smallest hash of the
id) and shuffled templates, both as `unknown`. A temperature, the least probability of one known family
(0.5 to 0.7) and that of all together (0.5 to 0.9) are set on a held-out part, so that about one in a hundred
unknown windows reaches each at most; a window passes that reaches either.

A window that passes is compared with the templates of all families, as it may name several: one is
confirmed if they share at least SIMILAR of the smaller set of five-word shingles (of all words, where
there are fewer), and not merely what a likelier confirmed family shares. In 'licensed under A or B'
the opening counts for B as well.

Training is repeatable. Scoring covers every line of every document. Null text counts as empty; a
text without tokens has no windows and no licence. Repeated rows give repeated rows, an empty table
an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import pick, slices, text_of

#: The usual short notices of licence families, as their stewards word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "The author has dedicated the work to the public domain by waiving all rights under CC0 1.0 Universal.",
    ),
}
FAMILIES = ["unknown", *TEMPLATES]

BUCKET_BITS = 18
BLOCK = 24
SHINGLE, SIMILAR = 5, 0.8
SAMPLE_ROWS = 600
TABLE_WORDS = 400_000
TOKEN = re.compile(r"[^\W_]+|\n")


def tokens(text: str) -> list[str]:
    """Words and line feeds."""
    return TOKEN.findall(text.lower())


def _plain(word: str) -> str:
    return re.sub(r"[0-9]", "0", word)


def _code(word: str) -> int:
    """A word's hash; never 0, which marks the end of a paragraph."""
    return zlib.crc32(_plain(word).encode("utf-8", "surrogatepass")) | 1 << 32


def buckets(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram that stays within its paragraph, the place of its first word and its bucket."""
    wide = np.concatenate([codes, np.zeros(2, "uint64")])
    n, places, found = len(codes), [], []
    inside = codes != 0
    key = codes * np.uint64(0x9E3779B97F4A7C15)
    for order in range(3):
        if order:
            follow = wide[order : n + order]
            inside = inside & (follow != 0)
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + follow * np.uint64(0x94D049BB133111EB)
        at = np.flatnonzero(inside)
        places.append(at)
        found.append((key[at] >> np.uint64(64 - BUCKET_BITS)).astype("int64"))
    return np.concatenate(places), np.concatenate(found)


def windows(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each token's block, and for each window its first and last block.

    Blocks are BLOCK tokens of one paragraph; a window is two neighbouring blocks of a paragraph, or
    its only one.
    """
    stop = codes == 0
    paragraph = np.cumsum(stop) - stop
    front = np.r_[0, np.flatnonzero(stop) + 1]
    within = np.arange(len(codes)) - front[paragraph]
    new = ~stop & (within % BLOCK == 0)
    block = np.cumsum(new) - 1
    owner = paragraph[new]
    count = len(owner)
    follows = np.zeros(count, bool)
    follows[1:] = owner[1:] == owner[:-1]
    has_next = np.zeros(count, bool)
    has_next[:-1] = follows[1:]
    pairs = np.flatnonzero(has_next)
    single = np.flatnonzero(~has_next & ~follows)
    first = np.concatenate([pairs, single])
    last = np.concatenate([pairs + 1, single])
    order = np.argsort(first, kind="stable")
    return block, first[order], last[order]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    plain = [_plain(w) for w in words]
    return {tuple(plain[i : i + SHINGLE]) for i in range(max(1, len(plain) - SHINGLE + 1))} if plain else set()


TEMPLATE_SHINGLES = {f: [shingles(tokens(t)) for t in ts] for f, ts in TEMPLATES.items()}


def similarity(words: list[str], family: str) -> float:
    """Largest share of the smaller set of shingles that a window and a template of the family share."""
    own = shingles(words)
    return max((len(own & t) / min(len(own), len(t)) for t in TEMPLATE_SHINGLES[family]), default=0.0) if own else 0.0


def repeated(words: list[str]) -> set[tuple[str, ...]]:
    """Shingles of 'licensed under A', 'licensed under B' in a window that says 'licensed under A or B'."""
    at = next((i for i, w in enumerate(words[1:], 1) if w == "under" and words[i - 1] in ("licensed", "released")), None)
    parts: list[list[str]] = [[]]
    for w in words[at + 1 :] if at else ():
        if w in ("or", "and"):
            parts.append([])
        elif parts[-1] or w not in ("either", "both", "the"):
            parts[-1].append(w)
    out: set[tuple[str, ...]] = set()
    for part in parts if len(parts) > 1 else ():
        named = part if "license" in part else [*part, "license"]
        out |= shingles(words[at - 1 : at + 1] + named) | shingles([*words[at - 1 : at + 1], "the", *named])
    return out


def confirmed(words: list[str], families: list[str]) -> list[tuple[str, float]]:
    """Those of the families, likeliest first, that a window confirms, with their similarity."""
    own = shingles(words)
    more = own | repeated(words)
    out: list[tuple[str, float]] = []
    seen: set[tuple[str, ...]] = set()
    for family in families:
        shared = {max(len(own & t) / min(len(own), len(t)), len(more & t) / min(len(more), len(t))): more & t for t in TEMPLATE_SHINGLES[family]} if own else {}
        like = max(shared, default=0.0)
        if like >= SIMILAR and not shared[like] <= seen:
            out.append((family, like))
            seen |= shared[like]
    return out


@dataclass
class Classifier:
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.5
    together: float = 0.5
    codes: dict[str, int] = field(default_factory=lambda: {"\n": 0})

    def __getstate__(self) -> dict:
        return {**self.__dict__, "codes": {"\n": 0}}

    def encoded(self, words: list[str]) -> np.ndarray:
        if len(self.codes) > TABLE_WORDS:
            self.codes = {"\n": 0}
        table = self.codes
        try:
            return np.fromiter(map(table.__getitem__, words), "uint64", len(words))
        except KeyError:
            table.update((w, _code(w)) for w in set(words) - table.keys())
            return np.fromiter(map(table.__getitem__, words), "uint64", len(words))

    def logits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of all windows, their blocks, and every token's block."""
        block, first, last = windows(codes)
        blocks = int(block[-1]) + 1 if len(block) else 0
        at, found = buckets(codes)
        used = self.weights.any(1)[found]  # most n-grams of a corpus were never trained on
        at, found = block[at[used]], found[used]
        sums = np.stack([np.bincount(at, self.weights[found, k], blocks) for k in range(len(self.bias))], 1)
        total = sums[first] + np.where((last > first)[:, None], sums[last], 0) + self.bias
        return total / self.temperature, first, last, block

    def matches(self, texts: list[str]) -> list[list[dict]]:
        """Per text its windows that pass: `family`, `probability`, `similarity`, `confirmed`, `paragraph`.

        A window has an entry for each family it confirms, or one, not confirmed, for the likeliest.
        """
        words: list[str] = []
        ends = []
        for text in texts:
            words += tokens(text)
            words.append("\n")
            ends.append(len(words))
        out: list[list[dict]] = [[] for _ in texts]
        codes = self.encoded(words)
        scores, first, last, block = self.logits(codes)
        if not len(scores):
            return out
        shares = np.exp(scores - scores.max(1, keepdims=True))
        shares /= shares.sum(1, keepdims=True)
        passed = np.flatnonzero((shares[:, 1:].max(1) >= self.least) | (1 - shares[:, 0] >= self.together))
        stop = codes == 0
        starts = np.zeros(int(block[-1]) + 2, "int64")
        place = np.flatnonzero(~stop)
        starts[block[place[::-1]]] = place[::-1]  # the first token of each block is written last
        for w in passed.tolist():
            a = int(starts[first[w]])
            own = words[a : a + 2 * BLOCK]
            own = own[: own.index("\n")] if "\n" in own else own
            text = int(np.searchsorted(ends, a, side="right"))
            likely = [FAMILIES[k] for k in np.argsort(-shares[w, 1:], kind="stable") + 1]
            sure = confirmed(own, likely)
            line = int(stop[(ends[text - 1] if text else 0) : a].sum())
            for family, like in sure or [(likely[0], similarity(own, likely[0]))]:
                share = float(shares[w, FAMILIES.index(family)])
                out[text].append({"family": family, "probability": share, "similarity": like, "confirmed": bool(sure), "paragraph": line})
        return out


def _varied(draw: np.random.Generator, words: list[str], around: list[list[str]]) -> list[str]:
    """A notice as it may occur: whole, or some words lost, cut at an end; other words around it."""
    out = words if draw.random() < 0.4 else [w for w in words if draw.random() > 0.05]
    if len(out) > 12 and draw.random() < 0.3:
        out = out[: len(out) - int(draw.integers(0, len(out) // 3))]
    if around and draw.random() < 0.5:
        other = around[int(draw.integers(len(around)))]
        cut = int(draw.integers(0, len(other) + 1))
        out = other[:cut][-30:] + out + other[cut:][:30]
    return out


def train(negative: list[list[str]], copies: int = 30, rounds: int = 60, seed: int = 7) -> Classifier:
    """The classifier from the templates and unknown windows, a quarter of all held out to calibrate it."""
    draw = np.random.default_rng(seed)
    negative = [w for w in negative if all(similarity(w, f) < 0.5 for f in TEMPLATES)]
    sets: list[tuple[list[str], int]] = [(w, 0) for w in negative]
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = tokens(text)
            sets += [(_varied(draw, words, negative), FAMILIES.index(family)) for _ in range(copies)]
            if len(words) > 2 * SHINGLE:
                sets += [(draw.permutation(words).tolist(), 0) for _ in range(copies // 6)]
    sets = [(w, y) for w, y in sets if w]
    order = draw.permutation(len(sets))
    corpus = order < len(negative)
    rows, cols, truth = [], [], np.array([sets[i][1] for i in order])
    for n, i in enumerate(order):
        codes = np.array([_code(w) for w in sets[i][0]], "uint64")
        found = buckets(codes)[1]
        rows.append(np.full(len(found), n))
        cols.append(found)
    row, col = np.concatenate(rows), np.concatenate(cols)
    known, col = np.unique(col, return_inverse=True)
    kinds, held = len(FAMILIES), np.arange(len(order)) % 4 == 0
    weights, bias = np.zeros((len(known), kinds)), np.zeros(kinds)
    speed, speed_bias = np.full(weights.shape, 1e-8), np.full(kinds, 1e-8)
    real = np.eye(kinds)[truth]

    def scores() -> np.ndarray:
        out = np.zeros((len(order), kinds))
        for k in range(kinds):
            out[:, k] = np.bincount(row, weights[col, k], len(order))
        return out + bias

    def share(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for _ in range(rounds):
        miss = (real - share(scores())) * ~held[:, None] / (~held).sum()
        slope = np.stack([np.bincount(col, miss[row, k], len(known)) for k in range(kinds)], 1) - 1e-5 * weights
        speed += slope**2
        weights += 0.3 * slope / np.sqrt(speed)
        slope_bias = miss.sum(0)
        speed_bias += slope_bias**2
        bias += 0.3 * slope_bias / np.sqrt(speed_bias)
    raw = scores()[held]
    heat = min(np.geomspace(0.5, 2, 17), key=lambda t: -np.log(share(raw / t)[np.arange(held.sum()), truth[held]] + 1e-12).mean())
    shown = share(raw / heat)
    unknown = shown[corpus[held]]
    one, all_ = np.r_[0.0, unknown[:, 1:].max(1)], np.r_[0.0, 1 - unknown[:, 0]]
    full = np.zeros((1 << BUCKET_BITS, kinds), "float32")
    full[known] = weights
    return Classifier(full, bias, float(heat), float(np.clip(np.quantile(one, 0.99), 0.5, 0.7)), float(np.clip(np.quantile(all_, 0.99), 0.5, 0.9)))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """The classifier, with unknown windows from lines of a bounded sample of `docs`."""
    rows = pick(docs, doc_id, text)
    mark = F.xxhash64("doc_id")
    marks = rows.select(mark.alias("mark")).orderBy("mark").limit(sample_rows)
    bound = marks.agg(F.max("mark")).first()[0]
    if bound is None:
        return train([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for t in batch.column(0).to_pylist():
                lines = sorted(((zlib.crc32(x.encode("utf-8", "surrogatepass")), x) for x in t.split("\n")))[:3]
                out += [w[: 2 * BLOCK] for _, x in lines if (w := tokens(x))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["words"])

    found = rows.where(mark <= bound).select("text").mapInArrow(run, "words array<string>")
    lines = found.orderBy(F.xxhash64("words"), "words").limit(3 * sample_rows)
    return train([list(r["words"]) for r in lines.collect()])


MATCHES = "array<struct<family:string,probability:double,similarity:double,confirmed:boolean,paragraph:int>>"


def scan(docs: DataFrame, classifier: Classifier, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, and `matches`: the windows of the whole text that pass, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kind = pa.list_(
        pa.struct(
            [("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("paragraph", pa.int32())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = shared.value.matches(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], [*keep, "matches"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, f"matches {MATCHES}"]))
