"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. Wider patterns propose
further candidates of the same kinds. Labelers vote on every candidate, base spans included, for,
against or not at all: the strict pattern, a validity rule, a gazetteer, the words around, and the
form. Expectation-maximisation on the counts of vote patterns over all documents estimates how
reliable each labeler is for each kind, and with that how likely each pattern is personal data. A
labeler that does not vote says nothing, so a wide candidate is not held against base spans for the
strict pattern that it lacks. Base spans are known to be personal data, so they show what its votes look like, and
how many of the wide candidates are is estimated from these alone; of a kind without any base span nothing is
known, so there the majority of votes stands. A vote for is never taken as evidence
against, nor the other way round: a labeler found so is taken as saying nothing. A logistic span
classifier is fitted to these likelihoods. It sees the votes but for the strict pattern's, the form, and
what no labeler looks at: the hashed words before and after a candidate, and its shape (runs of letters,
digits and marks). It learns from at most TRAIN_SPANS different candidates of each kind, base and wide ones apart (those
with the smallest hashes). A candidate that it gives at least SURE, and that overlaps no base span, is added.

The text is read once, in time linear in its length whatever it holds; candidates are written, and
counts of vote patterns (a fixed number at most) and the learned candidates' numbers are all that reaches the driver. Null text counts as
empty and has no spans. Repeated rows give repeated rows and count as often; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import pick, slices
from starmill.session import materialise

KINDS = ("email", "ip", "card", "phone")
SURE = 0.9
#: Different candidates that the classifier learns from, at most, of each kind, base and wide ones apart.
TRAIN_SPANS = 1_000
#: Classes that the words before, the words after and the shapes of candidates are hashed into.
EVIDENCE = 64
#: Characters around a candidate in which context words are looked for.
AROUND = 40

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
#: A match can only start where a run of digits does, so later starts need not be tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Wider patterns; each is bounded in length or anchored at a rare mark.
WIDE_EMAIL = re.compile(r"(?i) ?(?:\(at\)|\[at\]| at ) ?[a-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[a-z]{2,24}){1,4}(?![a-z0-9])")
#: Written-out marks inside a wide email.
DOT = re.compile(r"(?i) ?(?:\(dot\)|\[dot\]| dot |\.) ?")
MARKED = re.compile(r"(?i)\(at\)|\[at\]|\(dot\)|\[dot\]| dot ")
WIDE_IP = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])")
WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])")
WIDE_PHONE = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])")

#: Common top-level domains, calling codes, first digits of card issuers, context words.
TOP_LEVEL = set(
    "com org net edu gov mil int info biz name pro mobi app dev io ai co me tv cc"
    " ar at au be bg br by ca ch cl cn co cr cu cy cz de dk do ec ee eg es eu fi fr gr gt hk hn hr hu id ie il in ir is it"
    " jp ke kr lt lu lv ma mt mx my ng ni nl no nz pa pe ph pk pl pr pt py ro rs ru sa se sg si sk sv th tn tr tw ua uk us"
    " uy ve vn za example test invalid".split()
)
CALLING = (
    "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 7 81 82 84 86"
    " 90 91 92 93 94 95 98 351 352 353 354 356 357 358 359 370 371 372 373 375 380 381 385 386 420 421"
).split()
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")
CONTEXT = {
    "email": "mail email e-mail contact write reply correo courriel".split(),
    "ip": "ip host server address addr ping client adresse".split(),
    "card": "card visa credit pay payment mastercard tarjeta carte karte iban".split(),
    "phone": "tel phone call fax mobile cell telefon telefono whatsapp".split(),
}
#: A number without `+` that is written as a national one: trunk 0, or area code and exchange set off by more than spaces.
NATIONAL = re.compile(r"\(?0[0-9]+\)?[ .-]?[0-9]+[ .-][0-9]+|(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}")
AGAINST = "version order isbn serial part id ref number token hash doi total totals sum units".split()
WORDS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _octets(text: str) -> bool:
    """All four parts are at most 255, whatever their length."""
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @, dotted domain, found from each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        front = text[free:at]
        local = len(front) - len(front.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if local else None
        if found:
            yield at - local, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return _octets(found)
    if kind == "card":
        return 12 <= len(d := _digits(found)) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base spans, in order of start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for place, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(m.start(), place, m.end()) for m in pattern.finditer(text) if valid(KINDS[place], m[0])]
    return sorted(out)


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of the wider patterns."""
    out = []
    for m in WIDE_EMAIL.finditer(text):
        front = text[max(0, m.start() - 64) : m.start()]
        local = len(front) - len(front.rstrip(LOCAL))
        # 64 characters is the longest local part; within a longer run nothing starts
        if local and not (local == 64 and text[m.start() - 65 : m.start() - 64].strip(LOCAL) != text[m.start() - 65 : m.start() - 64]):
            out.append((m.start() - local, 0, m.end()))
    for place, pattern in ((1, WIDE_IP), (2, WIDE_CARD), (3, WIDE_PHONE)):
        out += [(m.start(), place, m.end()) for m in pattern.finditer(text)]
    return out


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """Base spans, then what the wider patterns find beside them, without overlaps."""
    base = base_spans(text)
    out = [(a, k, b, True) for a, k, b in base]
    taken = sorted((a, b) for a, _, b in base)
    n = last = 0
    for a, k, b in sorted(wide_spans(text), key=lambda s: (s[0], -s[2], s[1])):
        while n < len(taken) and taken[n][1] <= a:
            n += 1
        if a < last or any(x < b and a < y for x, y in taken[max(0, n - 4) : n + 4]):
            continue
        out.append((a, k, b, False))
        last = b
    return sorted(out)


def votes(text: str, start: int, place: int, end: int, base: bool) -> tuple[int, ...]:
    """Votes of the labelers: strict pattern, validity, gazetteer, context, form.

    The strict pattern votes for base spans and does not vote on others. The gazetteer votes against
    what it does not list, and the form against an email without any written mark and against bare
    groups of digits as a phone where no word before speaks of one: nothing else tells prose from these.
    """
    kind, found = KINDS[place], text[start:end]
    digits = _digits(found)
    if kind == "email":
        sound = ".." not in found and not found.startswith(".")
        listed = DOT.split(found)[-1].lower() in TOP_LEVEL
        form = 1 if "@" in found or MARKED.search(found) else -1
    elif kind == "ip":
        sound = _octets(found)
        listed = not found.startswith(("0.", "255."))
        form = text[end : end + 1] != "."
    elif kind == "card":
        sound = luhn(digits) and len(set(digits)) > 1
        listed = digits.startswith(ISSUERS)
        form = len(digits) in (15, 16) and len(set(found) - set("0123456789")) <= 1
    else:
        sound = 9 <= len(digits) <= 15
        national = NATIONAL.fullmatch(found)
        listed = digits.startswith(tuple(CALLING)) if found.startswith("+") else national
        form = found.count("(") == found.count(")") and "555-" not in found
    before = set(WORDS.findall(text[max(0, start - AROUND) : start].lower()))
    near = 1 if before & set(CONTEXT[kind]) else -1 if before & set(AGAINST) else 0
    if kind == "phone" and near < 1 and not set(found) & set("+()-"):
        form = -1
    whole = not text[start - 1 : start].isalnum() and not text[end : end + 1].isalnum()
    return (1 if base else 0, 1 if sound else -1, 1 if listed else -1, near, int(form) if whole else -1)


def form(text: str, start: int, end: int) -> int:
    """Length and marks of a candidate, as a number below FORMS."""
    found = text[start:end]
    return min((end - start) // 8, 7) * 4 + 2 * any(c in " ()-" for c in found) + found.isascii()


LETTERS, DIGITS = re.compile("[A-Za-z]+"), re.compile("[0-9]+")


def evidence(text: str, start: int, end: int) -> tuple[int, int, int]:
    """Classes of the word before a candidate, the word after it, and its shape; without a word the empty one's."""
    before = WORDS.findall(text[max(0, start - AROUND) : start])
    after = WORDS.search(text, end, end + AROUND)
    shape = DIGITS.sub("9", LETTERS.sub("a", text[start:end]))
    seen = (before[-1].lower() if before else "", after[0].lower() if after else "", shape)
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % EVIDENCE for x in seen)


LABELERS, FORMS = 5, 32
#: Steps of expectation-maximisation.
STEPS = 50


def reliabilities(counts: dict[tuple[int, ...], int], known: Collection[tuple[int, ...]] = (), steps: int = STEPS) -> dict[tuple[int, ...], float]:
    """Likelihood of each vote pattern (kind, votes) by expectation-maximisation, per kind.

    Labelers are taken as independent given the truth, and one that does not vote as saying nothing.
    The patterns in `known` are true, and weigh together at least as much as the others, whose share of
    true ones is estimated. It starts from the majority of the votes cast. A labeler whose vote for would
    speak against has one rate for both.
    """
    prior = np.array([[0.7, 0.3], [0.3, 0.7]])  # votes that every labeler is taken to have cast beforehand
    out: dict[tuple[int, ...], float] = {}
    for kind in sorted({p[0] for p in counts}):
        patterns = sorted(p for p in counts if p[0] == kind)
        seen = np.array([p[1:] for p in patterns]) + 1
        weight = np.array([counts[p] for p in patterns], "float64")
        sure = np.array([p in known for p in patterns])
        open_ = weight * ~sure
        if sure.any():
            weight = np.where(sure, weight * max(1, open_.sum() / weight[sure].sum()), weight)
        chosen = np.eye(3)[seen][:, :, [0, 2]]  # pattern, labeler, vote cast: against, for
        cast = np.maximum(chosen.sum((1, 2)), 1)
        likely = np.where(sure, 1, np.clip((seen - 1).sum(1) / (2 * cast) + 0.5, 0.05, 0.95))
        for _ in range(steps if open_.any() else 0):
            on, off = weight * likely, weight * (1 - likely)
            share = np.clip((open_ * likely).sum() / open_.sum(), 0.01, 0.99)
            given = np.stack([np.einsum("p,plv->lv", w, chosen) for w in (on, off)]) + prior[:, None, ::-1]
            rates = given / given.sum(2, keepdims=True)
            both = given.sum(0) / given.sum((0, 2))[:, None]
            rates = np.where((rates[0, :, 1] >= rates[1, :, 1])[None, :, None], rates, both)
            score = np.einsum("plv,lv->p", chosen, np.log(rates[0] / rates[1])) + np.log(share / (1 - share))
            likely = np.where(sure, 1, 1 / (1 + np.exp(-np.clip(score, -30, 30))))
        out.update(zip(patterns, likely.tolist()))
    return out


#: Features of one kind: one that always holds, the votes, the form, the evidence.
VOTED, FORMED = 1, 1 + 3 * LABELERS
WIDTH = FORMED + FORMS + 3 * EVIDENCE


def features(cast: Sequence[int], form: int, seen: Sequence[int]) -> list[int]:
    """Places of the features that hold for a candidate: the votes cast but for the strict pattern's, the form, the evidence."""
    voted = (VOTED + 3 * n + v + 1 for n, v in enumerate(cast) if n and v)
    return [0, *voted, FORMED + form, *(FORMED + FORMS + n * EVIDENCE + c for n, c in enumerate(seen))]


@dataclass(frozen=True)
class SpanClassifier:
    """Logistic weights, a row per kind."""

    weights: np.ndarray

    def likely(self, kind: int, cast: Sequence[int], form: int, seen: Sequence[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[kind, features(cast, form, seen)].sum(), -30, 30))))


@dataclass(frozen=True)
class Example:
    """A candidate as the classifier sees it, and how many there are of it."""

    kind: int
    votes: tuple[int, ...]
    form: int
    seen: tuple[int, ...]
    many: int


def fit(examples: Sequence[Example], likely: dict[tuple[int, ...], float], steps: int = 25) -> SpanClassifier:
    """Logistic weights by Newton steps that give the examples the likelihoods of their vote patterns."""
    weights = np.zeros((len(KINDS), WIDTH))
    # hashed evidence is held back more than votes, so that it decides only where it keeps recurring
    ridge = np.r_[np.full(FORMED + FORMS, 0.1), np.full(3 * EVIDENCE, 1.0)]
    for kind in sorted({e.kind for e in examples}):
        rows = sorted((e for e in examples if e.kind == kind), key=lambda e: (e.votes, e.form, e.seen))
        x = np.zeros((len(rows), WIDTH))
        for n, e in enumerate(rows):
            x[n, features(e.votes, e.form, e.seen)] = 1
        goal = np.array([likely[(kind, *e.votes)] for e in rows])
        # counts on a log scale, so that a common candidate does not drown the others
        weight = np.log1p([e.many for e in rows])
        w = weights[kind]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (goal - p)) - ridge * w
            curve = (x.T * (weight * np.maximum(p * (1 - p), 1e-4))) @ x + np.diag(ridge)
            w += np.clip(np.linalg.solve(curve, slope), -3, 3)
    return SpanClassifier(weights)


CANDIDATE = "array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>,form:int,seen:array<int>>>"


def proposed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `candidates` with their votes, of every row; the only pass over the texts."""
    names = ("start", "kind", "end", "base", "votes", "form", "seen")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()))
    kind = pa.list_(pa.struct(list(zip(names, kinds))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                [
                    dict(zip(names, (a, k, b, base, votes(t, a, k, b, base), form(t, a, b), evidence(t, a, b))))
                    for a, k, b, base in candidates(t)
                ]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "candidates"])

    rows = pick(docs, doc_id, text)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, candidates {CANDIDATE}")


def learn(proposals: DataFrame, train_spans: int = TRAIN_SPANS) -> SpanClassifier:
    """The classifier: EM on the vote patterns of all candidates, fitted on at most `train_spans` of each kind, base or not."""
    alike = proposals.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.base", "c.votes", "c.form", "c.seen").count()
    alike = materialise(alike, "pii-alike")
    counts = alike.groupBy("kind", "base", "votes").agg(F.sum("count").alias("many")).collect()
    likely: dict[tuple[int, ...], float] = {}
    for kind in {r["kind"] for r in counts}:
        of_kind = {(kind, *r["votes"]): r["many"] for r in counts if r["kind"] == kind}
        known = {(kind, *r["votes"]) for r in counts if r["kind"] == kind and r["base"]}
        likely |= reliabilities(of_kind, known, STEPS if known else 0)
    values = ("kind", "base", "votes", "form", "seen")
    order = Window.partitionBy("kind", "base").orderBy(F.xxhash64(*values), *values)
    picked = alike.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= train_spans)
    rows = picked.collect()
    return fit([Example(r["kind"], tuple(r["votes"]), r["form"], tuple(r["seen"]), r["count"]) for r in rows], likely)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def decided(proposals: DataFrame, classifier: SpanClassifier) -> DataFrame:
    """Per row `doc_id`, base spans per kind, `base` and `spans` (base and added) as text."""
    schema = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for found in batch.column(1).to_pylist():
                base = [(c["start"], c["kind"], c["end"]) for c in found if c["base"]]
                more = [
                    (c["start"], c["kind"], c["end"])
                    for c in found
                    if not c["base"] and classifier.likely(c["kind"], c["votes"], c["form"], c["seen"]) >= SURE
                ]
                many = [sum(k == place for _, k, _ in base) for place in range(len(KINDS))]
                rows.append((*many, joined(base), joined(base + more)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *(p.split()[0] for p in schema.split(", "))])

    return proposals.mapInArrow(run, f"doc_id {proposals.schema['doc_id'].dataType.simpleString()}, {schema}")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Propose, learn from all candidates, decide."""
    proposals = materialise(proposed(docs, doc_id, text), "pii-candidates")
    return decided(proposals, learn(proposals))
