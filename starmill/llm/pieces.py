"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is a chain of symbols, one per character at first. An agenda holds every adjacent pair
whose concatenation is a piece, ordered by score and then from the left; the best pair is merged
and its new neighbours join the agenda, until it is empty. Characters that are no piece fall back
to byte pieces.

Two neighbouring characters that stand side by side in no piece are never merged over, so a text
may be cut there and each segment be encoded by itself. Segments repeat, so each Python worker
keeps a bounded table of them. Every segment that enters the table is also encoded by the
sentencepiece library, in one call per Arrow slice, and must agree; as all ids come from the
table, the check covers all of them.

Null text counts as empty; an empty text has no ids but the end id. Repeated rows give repeated
rows, an empty table an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import slices, text_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Segments up to this length are merged side by side, so many at once; longer ones keep a heap each.
SHORT, ROWS_AT_ONCE = 48, 4096
#: Segments in each generation of a worker's table.
TABLE_ENTRIES = 120_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift, more = at + 1, shift + 7, data[at] >> 7
        if not more:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Pairs:
    """Every pair of symbols that makes a piece, in a hash table that is searched for many at once."""

    BITS = 20

    def __init__(self, codec: Codec):
        found = {}
        for piece in codec.ids:
            for i in range(1, len(piece)):
                left, right = codec.numbers.get(piece[:i]), codec.numbers.get(piece[i:])
                if left is not None and right is not None:
                    found[left << 32 | right] = (codec.place[piece], codec.numbers[piece])
        self.bits = max(self.BITS, (4 * len(found)).bit_length())
        keys = np.array(list(found), "int64")
        values = np.array(list(found.values()), "int64").reshape(-1, 2)
        self.keys = np.full(1 << self.bits, -1, "int64")
        self.slots = np.zeros((2, 1 << self.bits), "int32")
        self.slots[0] = len(codec.place)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]  # of those that want one slot, the last gets it
            got = self.keys[at] == keys[left]
            self.slots[:, at[got]] = values[left[got]].T
            left, at = left[~got], at[~got] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype("int64")

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or an empty one."""
        keys = left.astype("int64") << 32 | right
        at = self._slot(keys)
        off = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(off):
            at[off] = at[off] + 1 & (1 << self.bits) - 1
            held = self.keys[at[off]]
            off = off[(held != keys[off]) & (held >= 0)]
        return at

    def place(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in the agenda; the last one for pairs that make no piece."""
        return self.slots[0, self._find(left, right)]

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.slots[1, self._find(left, right)]


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class Codec:
    """Encoder and decoder of one model file.

    Covers models of merge type with byte fallback, identity normalisation and no user-defined
    or unused pieces; any other model is refused.
    """

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        options: dict[str, int | bytes] = {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field in (2, 3):
                options |= {f"{field}.{k}": v for k, v in _fields(value)}
        if options.get("2.3") != 2 or not options.get("2.35") or options.get("3.2"):
            raise ValueError("only merge-type models with byte fallback and identity normalisation")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has user-defined or unused pieces")
        if options.get("3.4", 1) or not options.get("3.5", 1) or options.get("2.24"):
            raise ValueError("the model changes white space")
        self.prefix = bool(options.get("3.3", 1))
        self.unknown_text = options.get("2.44", b" \xe2\x81\x87 ")
        self.end_id = options.get("2.42", 2)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        #: Place in the agenda's order; equal scores share a place.
        places = {s: n for n, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.place = {p: places[scores[i]] for p, i in self.ids.items()}
        #: Symbols by number: the pieces, then characters that occur in pieces only.
        self.names = [*self.ids, *sorted({c for p in self.ids for c in p} - set(self.ids))]
        self.numbers = {name: n for n, name in enumerate(self.names)}
        #: Symbol numbers by code point; one that is in no piece is numbered beyond all names.
        alone = {ord(name): number for name, number in self.numbers.items() if len(name) == 1}
        self.of_point = np.arange(max(alone, default=0) + 1, dtype="int32") + len(self.names)
        self.of_point[list(alone)] = list(alone.values())
        self.piece_ids = np.array(list(self.ids.values()), "int64")
        self.pairs = Pairs(self)
        self.byte_ids = [i for i, k in enumerate(self.kinds) if k == BYTE]
        self.shown = [self._shown(i) for i in range(len(self.pieces))]
        self.shown_array = pa.array(self.shown, pa.binary())
        self.cut = self._cutter()

    def _shown(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == NORMAL:
            return self.pieces[i].replace(SPACE, " ").encode()
        if kind == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        return self.unknown_text if kind == UNKNOWN else b""

    def _cutter(self) -> re.Pattern:
        """Segments of a text: runs between places no piece reaches over.

        Cut are: before a space mark that follows another character, around characters that are
        part of no longer piece, and before a punctuation mark that follows a letter in no piece.
        Each kind of cut is taken only if the vocabulary allows it.
        """
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        inner = {c for pair in pairs for c in pair}
        marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
        after_letter = {pair[1] for pair in pairs if pair[0].isalnum()}
        alone = "".join(re.escape(c) for c in ["\n", *marks] if c not in inner)
        marks = "".join(re.escape(c) for c in marks if c not in after_letter and c in inner)
        #: Whether no piece reaches from another character over to a space mark.
        self.spaced = not any(pair[1] == SPACE and pair[0] != SPACE for pair in pairs)
        if not self.spaced:
            return re.compile(r"(?s).+")
        alone = f"[{alone}]|" if alone else ""
        plain = rf"[^{SPACE}{marks}{alone[1:-2]}]++"
        follow = rf"(?:(?<![^\W_])[{marks}]++(?:{plain})?+)*+" if marks else ""
        first = rf"|[{marks}]++(?:{plain})?+{follow}" if marks else ""
        return re.compile(rf"{alone}{SPACE}++(?:{plain})?+{follow}{first}|{plain}{follow}")

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", SPACE)
        return self.cut.findall(SPACE + marked if self.prefix else marked)

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda of adjacent pairs."""
        return np.frombuffer(self.merge_many([segment])[0], "<i4").tolist()

    def merge_many(self, segments: list[str]) -> list[bytes]:
        """Ids of segments, each as 4-byte numbers: short ones side by side, long ones by a heap each."""
        out = [b""] * len(segments)
        length = np.fromiter(map(len, segments), "int64", len(segments))
        order = np.argsort(length, kind="stable")
        short, long = np.split(order, [np.searchsorted(length[order], SHORT, "right")])
        for start in range(0, len(short), ROWS_AT_ONCE):
            part = short[start : start + ROWS_AT_ONCE].tolist()
            for n, packed in zip(part, self._merged_rows([segments[n] for n in part])):
                out[n] = packed
        for n in long.tolist():
            out[n] = _pack(self._ids(self._merged_long(segments[n])))
        return out

    def _merged_rows(self, segments: list[str]) -> list[bytes]:
        """A row of symbols per segment, and beside it its agenda: the places of its adjacent pairs.

        In each round the least entry of every row, the leftmost of equal ones, is merged; what
        stands behind it moves up, and the two pairs beside it are looked up anew.
        """
        none, out = len(self.place), [b""] * len(segments)
        length = np.fromiter(map(len, segments), "int64", len(segments))
        width = int(length.max(initial=1))
        row = np.repeat(np.arange(len(segments)), length)
        column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "uint32")
        symbols = np.full((len(segments), width + 1), -1, "int32")
        known = points < len(self.of_point)
        symbols[row, column] = np.where(known, self.of_point[points * known], points.astype("int32") + len(self.names))
        agenda = np.full(symbols.shape, none, "int32")
        pairs = symbols[:, 1:] >= 0
        agenda[:, :-1][pairs] = self.pairs.place(symbols[:, :-1][pairs], symbols[:, 1:][pairs])
        place, columns = np.arange(len(segments)), np.arange(width + 1)
        while len(place):
            lines = np.arange(len(place))
            best = agenda.argmin(1)
            going = agenda[lines, best] < none
            if not going.all():
                self._finish(place[~going], symbols[~going], out)
                place, symbols, agenda, best = place[going], symbols[going], agenda[going], best[going]
                lines = np.arange(len(place))
                if not len(place):
                    break
            made = self.pairs.made(symbols[lines, best], symbols[lines, best + 1])
            behind = columns > best[:, None]
            symbols[:, :-1] = np.where(behind[:, :-1], symbols[:, 1:], symbols[:, :-1])
            agenda[:, :-1] = np.where(columns[:-1] >= best[:, None], agenda[:, 1:], agenda[:, :-1])
            symbols[lines, best] = made
            symbols[:, width], agenda[:, width] = -1, none
            for left in (best - 1, best):
                has = np.flatnonzero((left >= 0) & (symbols[lines, left + 1] >= 0))
                agenda[has, left[has]] = self.pairs.place(symbols[has, left[has]], symbols[has, left[has] + 1])
                end = np.flatnonzero((left >= 0) & (symbols[lines, left + 1] < 0))
                agenda[end, left[end]] = none
        return out

    def _finish(self, place: np.ndarray, symbols: np.ndarray, out: list[bytes]) -> None:
        used = symbols >= 0
        plain = ~(symbols >= len(self.ids)).any(1)
        ids = self.piece_ids[symbols[plain][used[plain]]].astype("<i4").tobytes()
        at = 0
        for n, many in zip(place[plain].tolist(), used[plain].sum(1).tolist()):
            out[n] = ids[at : at + 4 * many]
            at += 4 * many
        for n, row in zip(place[~plain].tolist(), symbols[~plain].tolist()):
            strange = len(self.names)
            out[n] = _pack(self._ids([self.names[x] if x < strange else chr(x - strange) for x in row if x >= 0]))

    def _ids(self, symbols: list[str]) -> list[int]:
        out = list(map(self.ids.get, symbols))
        if None in out:
            known = zip(symbols, out)
            return [i for s, n in known for i in ([n] if n is not None else [self.byte_ids[b] for b in s.encode()])]
        return out

    def _merged_long(self, segment: str) -> list[str]:
        """The agenda as a heap, for time in proportion to n log n."""
        place = self.place
        symbols: list[str] = list(segment)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            both = symbols[i] + symbols[i + 1]
            if both in place:
                agenda.append((place[both], i, i + 1, both))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                joined = both + symbols[follow]
                if joined in place:
                    heapq.heappush(agenda, (place[joined], left, follow, joined))
            lead = before[left]
            if lead >= 0:
                joined = symbols[lead] + both
                if joined in place:
                    heapq.heappush(agenda, (place[joined], lead, left, joined))
        return [symbol for symbol in symbols if symbol]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.merge_many(self.segments(text))), "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of `ids`; the prefix space goes, bytes that form no character become U+FFFD."""
        raw = b"".join(map(self.shown.__getitem__, ids))
        if self.prefix and ids:
            first = next((i for i in ids if self.kinds[i] != CONTROL), None)
            if first is not None and self.kinds[first] == NORMAL and self.pieces[first].startswith(SPACE):
                raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: list[int]) -> str:
        """Each byte outside a character is one U+FFFD; a character's bytes lie in one run of byte pieces."""
        out: list[str] = []
        run = b""
        ids = [i for i in ids if self.kinds[i] != CONTROL]
        for n, i in enumerate([*ids, None]):
            if i is not None and self.kinds[i] == BYTE:
                run += self.shown[i]
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                at += size
            run = b""
            if i is not None:
                shown = self.shown[i].decode()
                drop = n == 0 and self.prefix and self.kinds[i] == NORMAL and shown.startswith(" ")
                out.append(shown[1:] if drop else shown)
        return "".join(out)


@lru_cache(maxsize=4)
def _codec(model: bytes) -> Codec:
    return Codec(model)


@lru_cache(maxsize=4)
def _library(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _key(segment: str) -> str:
    """A segment's name in the table: a word stands for itself with a space mark before it, any other has one more."""
    return segment[1:] if segment[0] == SPACE and len(segment) > 1 and segment[1] != SPACE else SPACE + segment


class Table:
    """Packed ids of checked segments, by `_key`, as a worker keeps them over its tasks.

    Two generations of at most TABLE_ENTRIES each (and what one slice adds): what is looked up moves
    to the younger one; when that is full it becomes the older, whose entries are forgotten.
    """

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, segments: set[str]) -> dict[str, bytes]:
        found = {s: packed for s in segments if (packed := self.young.get(s)) is not None}
        if len(found) < len(segments):
            found |= {s: packed for s in segments if s not in found and (packed := self.old.get(s)) is not None}
        return found

    def keep(self, found: dict[str, bytes], most: int) -> None:
        self.young |= found
        if len(self.young) > most:
            self.old, self.young = self.young, {}


_TABLES: dict[str, Table] = {}


class Encoder:
    """Encodes slices of texts; every segment comes from the worker's table or is checked anew."""

    def __init__(self, model: bytes, most: int = TABLE_ENTRIES):
        self.codec, self.library, self.most = _codec(model), _library(model), most
        self.table = _TABLES.setdefault(hashlib.sha256(model).hexdigest(), Table())
        self.lead = _pack(self.codec._ids([SPACE, "\n"]))

    def _learned(self, keys: list[str]) -> dict[str, bytes]:
        """Merge segments and hold them against the library, all in one call.

        The library puts a space mark before a text. A segment that starts with one is handed over
        without it; any other gets a line feed before it, which no piece reaches over, so the ids
        of the segment are what follows that line feed's.
        """
        segments = [k[1:] if k[0] == SPACE else SPACE + k for k in keys]
        plain, merged = keys.copy(), self.codec.merge_many(segments)
        own = merged.copy()
        for n in [n for n, k in enumerate(keys) if k[0] == SPACE]:
            led = segments[n][0] != SPACE or len(segments[n]) == 1
            plain[n] = "\n" + segments[n] if led else segments[n][1:]
            own[n] = self.lead + merged[n] if led else merged[n]
        theirs = self.library.encode(plain, num_threads=1)
        many = np.fromiter(map(len, theirs), "int64", len(theirs))
        flat = np.fromiter(chain.from_iterable(theirs), "<i4", int(many.sum()))
        same = np.array_equal(many * 4, np.fromiter(map(len, own), "int64", len(own)))
        if not same or flat.tobytes() != b"".join(own):
            at = next(n for n, (ids, packed) in enumerate(zip(theirs, own)) if _pack(ids) != packed)
            raise ValueError(f"ids differ from the library's for {segments[at]!r}: {np.frombuffer(merged[at], '<i4').tolist()} and {theirs[at]}")
        return dict(zip(keys, merged))

    def slice(self, texts: list[str], end: bool) -> pa.ListArray:
        """A short word that single spaces set off is a segment by itself, looked up once per slice; long
        words and any other text are cut."""
        plain = self.codec.prefix and self.codec.spaced
        apart = [w if plain and SPACE not in t and "" not in (w := t.split(" ")) else None for t in texts]
        words = set().union(*(ws for ws in apart if ws))
        long = [w for w in words if len(w) >= SHORT]
        cut = {t: [_key(s) for s in self.codec.segments(t)] for t in [*long, *(t for t, ws in zip(texts, apart) if ws is None)]}
        words.difference_update(long)
        words.update(*cut.values())
        found = self.table.known(words)
        if len(found) < len(words):
            found |= self._learned([w for w in words if w not in found])
        self.table.keep(found, self.most)
        whole = {t: b"".join(map(found.__getitem__, keys)) for t, keys in cut.items()}
        found |= {w: whole[w] for w in long}
        tail = struct.pack("<i", self.codec.end_id) if end else b""
        out = [(whole[t] if ws is None else b"".join(map(found.__getitem__, ws))) + tail for t, ws in zip(texts, apart)]
        offsets = np.zeros(len(texts) + 1, "int32")
        np.cumsum([len(p) // 4 for p in out], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(out), "<i4")))


def _decoded(codec: Codec, lists: pa.ListArray) -> pa.Array:
    """The texts of lists of ids: what the ids show, laid side by side; odd ones go through `decode`."""
    flat = lists.flatten()
    taken = codec.shown_array.take(flat)
    at = np.frombuffer(taken.buffers()[1], "int32")[taken.offset : taken.offset + len(taken) + 1].tolist()
    raw = memoryview(taken.buffers()[2] or b"")
    flat = flat.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
    out = []
    for a, b in zip([0, *ends], ends):
        if a < b and codec.kinds[flat[a]] == CONTROL:
            out.append(codec.decode(flat[a:b].tolist()))
            continue
        drop = a < b and codec.prefix and codec.kinds[flat[a]] == NORMAL and codec.pieces[flat[a]].startswith(SPACE)
        try:
            out.append(str(raw[at[a] + drop : at[b]], "utf-8"))
        except UnicodeDecodeError:
            out.append(codec.decode(flat[a:b].tolist()))
    return pa.array(out, pa.string())


def encode(docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end: bool = True) -> DataFrame:
    """The columns `keep`, and `ids`: the whole text's ids, with the end id if `end`.

    `model` is the model file's content, a bounded size that travels with the tasks.
    """
    Codec(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in slices(batches):
            ids = encoder.slice(batch.column(batch.num_columns - 1).to_pylist(), end)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*keep, "ids"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "ids array<int>"]))


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, and `text`: what the ids stand for. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in slices(batches):
            texts = _decoded(codec, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*keep, "text"])

    rows = encoded.select(*(F.col(f"`{k}`") for k in keep), F.col(f"`{ids}`").alias("_ids"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "text string"]))


def round_trip(docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, `ids` with the end id, and `text` decoded from them, in one Python pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in slices(batches):
            ids = encoder.slice(batch.column(batch.num_columns - 1).to_pylist(), True)
            texts = _decoded(encoder.codec, ids)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, texts], [*keep, "ids", "text"])

    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text_of(text).alias("_text"))
    kept = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*kept, "ids array<int>", "text string"]))


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded text."""
    return round_trip(docs, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
