"""Alignment of two tokenizers' tokens over the same bytes.

Side A is a byte-level BPE of the `tokenizers` library, side B a sentencepiece model that puts a
space before the text; A is given that space, so both cut the same bytes. Each batch lays the
tokens of its documents out by byte offset. Tokens are looked up by segment: where both models let
no token reach over a single space between two other characters, a text is cut there, and a worker
encodes each distinct segment once with both libraries, keeping a bounded table. Two `merge_asof` joins, keyed by document, give every
token's start the other side's token that covers it; both directions together are the overlapping
pairs. A pair with equal ends closes a group: the least run of whole tokens that both sides share.
Links are all pairs of an A and a B token of one group.

Statistics over the corpus: a pair of ids counts the documents in which it is linked, and a pair is
best if no other of its A id has a larger count (ties are all best). Documents meet the counts of
their pairs in a join; the pairs that hold most rows, fewer than `HOT_SHARE`, are broadcast, so a
frequent word is never one task, and only the rows of rarer pairs are shuffled.

A null or empty text, and one whose tokens do not spell it (a model may normalise it, and U+2581
reads as a space), has no tokens, no groups and zero everywhere; `groups` is then empty. Special
tokens' strings in a text are plain text. Rows that repeat are documents of their own. An empty
table gives an empty result. Only the named columns are read, so no other can clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import pick, slices
from starmill.llm.pieces import Codec
from starmill.operators.skew import join_counted
from starmill.session import materialise

#: A link's two ids and the document's place in its batch share 64 bits.
ID_BITS = 21
#: Where texts are cut, if the models allow it.
CUT = re.compile(r" (?<=\S )(?=\S)")
#: A worker's table of segments is emptied when it holds so many, and a segment of more characters leaves it at once.
TABLE_ENTRIES, KEPT_CHARS = 300_000, 64
#: Rows and bytes of text that are laid out at once: an encoding takes some hundred times its text.
BATCH_ROWS, BATCH_BYTES = 512, 1 << 18
#: Groups with more links than this are reduced to distinct ids before their links are formed.
WIDE = 4096
#: Pairs that hold more than one in so many rows are met by broadcast; there are fewer than so many.
HOT_SHARE = 1 << 16

SCHEMA = (
    "n_a bigint, n_b bigint, n_groups bigint, n_overlaps bigint, n_links bigint, groups string, "
    "links array<struct<a:int,b:int,times:bigint>>"
)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Side:
    """One tokenizer in a task: ids of texts, and the bytes and digits of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    spelled: list[bytes]
    length: np.ndarray

    @staticmethod
    def of(encode: Callable[[list[str]], list[list[int]]], entries: list[bytes]) -> Side:
        if len(entries) > 1 << ID_BITS:
            raise ValueError(f"vocabularies have up to {1 << ID_BITS} ids")
        return Side(encode, entries, np.array([len(e) for e in entries], "int64"))

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join([self.spelled[i] for i in ids])


@lru_cache(maxsize=2)
def byte_side(model: bytes) -> Side:
    """A byte-level BPE from its JSON file's content."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    tokenizer.encode_special_tokens = True
    alphabet = byte_alphabet()
    entries = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        # an added token is no word of the byte alphabet; it is never produced
        entries[i] = bytes(alphabet[c] for c in entry) if set(entry) <= alphabet.keys() else entry.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        spaced = [f" {t}" for t in texts]
        return [found.ids for found in tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]

    return Side.of(encode, entries)


@lru_cache(maxsize=2)
def piece_side(model: bytes) -> Side:
    """A sentencepiece model from its file's content."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    entries = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return Side.of(lambda texts: pieces.encode(texts, num_threads=1), entries)


@dataclass(frozen=True)
class Tokens:
    """One side's tokens of a batch, laid out by byte: ids, starts, ends, place of the document."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def _laid_out(side: Side, packed: list[bytes], doc: np.ndarray) -> Tokens:
    """Tokens of segments one after another; `doc` is the place of each segment's document."""
    flat = np.frombuffer(b"".join(packed), "int32").astype("int64")
    end = np.cumsum(side.length[flat])
    sizes = np.fromiter(map(len, packed), "int64", len(packed)) >> 2
    return Tokens(flat, end - side.length[flat], end, np.repeat(doc, sizes))


def may_cut(byte_model: bytes, piece_model: bytes) -> bool:
    """Whether both models encode the two sides of a place where CUT matches independently.

    The byte-level pattern starts a word at such a space and ends the one before it. The piece model
    must leave texts as they are, put a space before them, and have no piece with a space mark after another character.
    """
    made = json.loads(byte_model)
    split = made["pre_tokenizer"] or {}
    by_words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not made["normalizer"]
    if not by_words or not all(token["special"] for token in made["added_tokens"]):
        return False
    try:
        codec = Codec(piece_model)
    except ValueError:
        return False
    return codec.spaced and codec.prefix


_may_cut = lru_cache(maxsize=2)(may_cut)
#: Per pair of models the packed ids of segments on either side, as a worker keeps them over its tasks.
_TABLES: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}


def _shared_out(side: Side, segments: list[str], ends: np.ndarray) -> list[bytes] | None:
    """Packed ids of each segment from those of all as one text; None if its tokens do not spell it."""
    text = " ".join(segments)
    ids = side.encode([text])[0]
    if side.bytes_of(ids) != f" {text}".encode():
        return None
    reached = np.cumsum(side.length[ids])
    last = np.searchsorted(reached, ends)
    if not np.array_equal(reached[last], ends):
        return None
    packed, cuts = array("i", ids).tobytes(), (4 * (last + 1)).tolist()
    return [packed[i:j] for i, j in zip([0, *cuts], cuts)]


class Encoder:
    """Tokens of both sides for batches of texts."""

    def __init__(self, byte_model: bytes, piece_model: bytes, cut: bool | None = None):
        self.a, self.b = byte_side(byte_model), piece_side(piece_model)
        self.cut = _may_cut(byte_model, piece_model) if cut is None else cut
        self.table = _TABLES.setdefault(hashlib.sha256(byte_model + piece_model).hexdigest(), ({}, {}))

    def _learn(self, new: list[str]) -> set[str]:
        """Put the packed ids of segments into the table; those that a side does not spell have none and are returned.

        Segments that may stand side by side go through the libraries as one text, whose tokens end where they do.
        """
        plain = [s for s in new if self.cut and "▁" not in s and not s[0].isspace() and not s[-1].isspace()]
        sizes = np.fromiter((len(s.encode()) + 1 for s in plain), "int64", len(plain))
        sides = [_shared_out(side, plain, np.cumsum(sizes)) for side in (self.a, self.b)] if plain else []
        if plain and None not in sides:
            for table, packed in zip(self.table, sides, strict=True):
                table.update(zip(plain, packed, strict=True))
            new = [s for s in new if s not in self.table[0]]
        spoilt = set()
        for segment, x, y in zip(new, self.a.encode(new), self.b.encode(new), strict=True):
            text = f" {segment}".encode()
            if self.a.bytes_of(x) != text or self.b.bytes_of(y) != text:
                spoilt.add(segment)
                x = y = []
            self.table[0][segment], self.table[1][segment] = array("i", x).tobytes(), array("i", y).tobytes()
        return spoilt

    def tokens(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Of both sides; none where a text is empty or a side does not spell it."""
        parts = [(CUT.split(text) if self.cut else [text]) if text else [] for text in texts]
        flat = list(chain.from_iterable(parts))
        distinct = set(flat)
        new = [s for s in distinct if s not in self.table[0]]
        spoilt = self._learn(new)
        if spoilt:
            parts = [[] if spoilt.intersection(part) else part for part in parts]
            flat = list(chain.from_iterable(parts))
        doc = np.repeat(np.arange(len(texts)), [len(part) for part in parts])
        sides = tuple(
            _laid_out(side, [table[s] for s in flat], doc) for side, table in zip((self.a, self.b), self.table, strict=True)
        )
        for table in self.table:
            # what is not spelled, or long, is found out anew each time
            for s in [s for s in new if len(s) > KEPT_CHARS or s in spoilt]:
                del table[s]
            if len(table) > TABLE_ENTRIES:
                table.clear()
        return sides


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping tokens of A and B as places in the batch, in order of the byte where their overlap starts."""
    left = pd.DataFrame({"at": a.start, "doc": a.doc, "a": np.arange(len(a.ids))})
    right = pd.DataFrame({"at": b.start, "doc": b.doc, "b": np.arange(len(b.ids))})
    of_a = pd.merge_asof(left, right, on="at", by="doc")["b"].to_numpy()
    of_b = pd.merge_asof(right, left, on="at", by="doc")["a"].to_numpy()
    # a pair whose tokens start together is found from both directions
    late = np.flatnonzero(a.start[of_b] != b.start)
    order = np.argsort(np.r_[a.start, b.start[late]], kind="stable")
    return np.r_[left["a"].to_numpy(), of_b[late]][order], np.r_[of_a, late][order]


def grouped(a: Tokens, b: Tokens, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every A and every B token, and the document of every group."""
    left, right = pairs
    closing = a.end[left] == b.end[right]
    group = np.cumsum(closing) - closing
    a_group, b_group = np.empty(len(a.ids), "int64"), np.empty(len(b.ids), "int64")
    a_group[left], b_group[right] = group, group
    return a_group, b_group, a.doc[left[closing]]


def _expanded(a_ids: np.ndarray, b_ids: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, ...]:
    """All links of groups that lie one after another: ids, times, place of the group."""
    group = np.repeat(np.arange(len(na)), na)
    reach = nb[group]
    total = int(reach.sum())
    within = np.arange(total) - np.repeat(np.cumsum(reach) - reach, reach)
    first = np.repeat((np.cumsum(nb) - nb)[group], reach)
    return np.repeat(a_ids, reach), b_ids[first + within], np.ones(total, "int64"), np.repeat(group, reach)


def links(a: Tokens, b: Tokens, a_group: np.ndarray, b_group: np.ndarray, group_doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct links per document in order of document and ids: keys (document, a, b) and times."""
    na, nb = (np.bincount(g, minlength=len(group_doc)) for g in (a_group, b_group))
    narrow = na * nb <= WIDE
    mine, theirs = narrow[a_group], narrow[b_group]
    x, y, times, place = _expanded(a.ids[mine], b.ids[theirs], na[narrow], nb[narrow])
    parts = [((group_doc[narrow][place] << ID_BITS | x) << ID_BITS | y, times)]
    a_first, b_first = np.cumsum(na) - na, np.cumsum(nb) - nb
    for g in np.flatnonzero(~narrow):
        x, nx = np.unique(a.ids[a_first[g] : a_first[g] + na[g]], return_counts=True)
        y, ny = np.unique(b.ids[b_first[g] : b_first[g] + nb[g]], return_counts=True)
        keys = (group_doc[g] << ID_BITS | np.repeat(x, len(y))) << ID_BITS | np.tile(y, len(x))
        parts.append((keys, np.outer(nx, ny).ravel()))
    keys, times = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, "int64")
    return keys[new], np.add.reduceat(times, new) if len(new) else times


@lru_cache(maxsize=2)
def _digits(most: int) -> np.ndarray:
    """Every id in digits, followed by each of the separators that may come after it."""
    out = np.empty((3, most), object)
    for i, mark in enumerate(",|;"):
        out[i] = [f"{n}{mark}" for n in range(most)]
    return out.ravel()


def shown(a: Tokens, b: Tokens, a_group: np.ndarray, b_group: np.ndarray, docs: int, most: int) -> list[str]:
    """Per document its groups, such as `a1,a2|b1;a3|b2,b3`."""
    comma, bar, semicolon = 0, most, 2 * most
    last_a = np.r_[a_group[1:] != a_group[:-1], True][: len(a_group)]
    last_b = np.r_[b_group[1:] != b_group[:-1], True][: len(b_group)]
    codes = np.r_[a.ids + np.where(last_a, bar, comma), b.ids + np.where(last_b, semicolon, comma)]
    order = np.argsort(np.r_[2 * a_group, 2 * b_group + 1], kind="stable")
    words = _digits(most)[codes[order]]
    ends = np.cumsum(np.bincount(a.doc, minlength=docs) + np.bincount(b.doc, minlength=docs))
    return ["".join(words[i:j])[:-1] for i, j in zip(np.r_[0, ends[:-1]], ends, strict=True)]


def align_batch(texts: list[str], encoder: Encoder) -> list[pa.Array]:
    """The columns of SCHEMA for a batch of texts."""
    left, right = encoder.tokens(texts)
    pairs = overlaps(left, right)
    a_group, b_group, group_doc = grouped(left, right, pairs)
    keys, times = links(left, right, a_group, b_group, group_doc)
    docs = len(texts)
    link_doc, mask = keys >> 2 * ID_BITS, (1 << ID_BITS) - 1

    def per_doc(doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weights, minlength=docs).astype("int64")

    offsets = np.r_[0, np.cumsum(per_doc(link_doc))]
    fields = {"a": pa.array((keys >> ID_BITS & mask).astype("int32")), "b": pa.array((keys & mask).astype("int32")), "times": pa.array(times)}
    linked = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return [
        pa.array(per_doc(left.doc)),
        pa.array(per_doc(right.doc)),
        pa.array(per_doc(group_doc)),
        pa.array(per_doc(left.doc[pairs[0]])),
        pa.array(per_doc(link_doc, times)),
        pa.array(shown(left, right, a_group, b_group, docs, max(len(encoder.a.length), len(encoder.b.length))), pa.string()),
        pa.ListArray.from_arrays(pa.array(offsets.astype("int32")), linked),
    ]


def align(docs: DataFrame, byte_model: bytes, piece_model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: numbers of tokens, groups, overlapping pairs and links, its `groups` as text, and
    its distinct `links` with how often each occurs.

    The models are the files' contents, a bounded size that travels with the tasks.
    """
    names = ["doc_id", *(part.split()[0] for part in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(byte_model, piece_model)
        for batch in slices(batches, BATCH_ROWS, BATCH_BYTES):
            columns = align_batch(batch.column(1).to_pylist(), encoder)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = pick(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def pair_counts(linked: DataFrame) -> DataFrame:
    """Per pair of ids `a`, `b` the number of documents `docs` that link it, and whether it is `best` of its `a`.

    `linked` has one row per document and distinct pair. The largest count per A id is one row per
    entry of a vocabulary, which is bounded and broadcast.
    """
    counts = materialise(linked.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scored(docs: DataFrame, byte_model: bytes, piece_model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document what `align` counts, the digest of its groups (empty without tokens), the links
    that are best of their A id (`n_best`), and the counts of all its links' pairs summed.

    Texts are encoded once; the numbers, digests and links are written, and all else reads them.
    """
    aligned = align(docs, byte_model, piece_model, doc_id, text)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    row = F.monotonically_increasing_id().alias("row")
    numbers = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links"]
    written = materialise(aligned.select(row, "doc_id", *numbers, digest, "links"), "aligned")
    linked = written.select("row", F.inline("links"))
    counts = materialise(pair_counts(linked.select("a", "b")), "pair-best")
    met = join_counted(linked, counts, ["a", "b"], "docs", HOT_SHARE)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    return (
        written.drop("links")
        .join(sums, "row", "left")
        .select("doc_id", *numbers, *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
    )
