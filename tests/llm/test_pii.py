"""Base spans against the plain patterns, EM on made votes, added spans, odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from starmill.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), place, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    pieces = ["a", "b.", "@", "@x.", ".", "1", "255", "256", "4111 1111 1111 1111", "+1 (2", "+", ")", "-", " ", "é", "😀", "12.3.4.5", "%", "x@y.z", "0000"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == brute(text), text


def test_query_equals_the_patterns(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op3_pii(spark, sf_dir).collect()}
    assert len(got) == documents.count()
    for r in documents.collect():
        base = brute(r.text)
        shown = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in base)
        row = got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(filter(None, shown.split(","))) <= set(row.spans.split(","))


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a.", "+1", "@", "1-", "a@", "x at y ", "(at)"])
def test_long_runs_take_linear_time(unit):
    pii.candidates(unit * 100_000 + "@")


def test_texts_without_digits_have_all_their_candidates():
    assert [c[:3] for c in pii.candidates("jane (at) example.com")] == [(0, 0, 21)]
    rng = random.Random(5)
    pieces = ["a", "jane", " (at) ", " (AT) ", "[at]", " at ", " At ", "(at)", "b.com", ".", " dot ", " DOT ", "(dot)", "(DOT)", "[dot]", "org", " ", "\n", "é"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        want, last = [], 0
        for a, k, b in sorted(pii.wide_spans(text), key=lambda s: (s[0], -s[2], s[1])):
            if a >= last:
                want.append((a, k, b, False))
                last = b
        assert pii.candidates(text) == want, text
        found += len(want)
    assert found > 1_000


def test_em_finds_the_unreliable_labeler():
    draw = np.random.default_rng(1)
    right = (0.95, 0.9, 0.8, 0.5, 0.85)
    counts, truths = {}, {}
    for _ in range(20_000):
        truth = draw.random() < 0.4
        cast = tuple((1 if truth else -1) if draw.random() < p else (-1 if truth else 1) for p in right)
        counts[(0, *cast)] = counts.get((0, *cast), 0) + 1
        truths.setdefault((0, *cast), []).append(truth)
    likely = pii.reliabilities(counts)
    off = [abs(likely[p] - np.mean(ts)) for p, ts in truths.items() if len(ts) > 200]
    assert max(off) < 0.1
    assert abs(likely[(0, 1, 1, 1, 1, 1)] - likely[(0, 1, 1, 1, -1, 1)]) < 0.02


def test_candidates_are_added_beside_the_base(spark):
    rows = [f"email me: user{i}@mail.example.com or call +1 (212) 535-01{i:02d} today" for i in range(60)]
    rows += [f"please email jane{i} (at) host{i} (dot) com" for i in range(20)] + [f"version {i}.300.2.1 of it" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert all(len(got[i].split(",")) == 2 for i in range(60))
    assert not any(got[i] for i in range(80, 120))
    text = rows[65]
    found = [s.split(":") for s in got[65].split(",") if s]
    assert [(k, text[int(a) : int(b)]) for k, a, b in found] in ([], [("email", "jane5 (at) host5 (dot) com")])


def test_planted_spans_beside_prose_are_added(spark):
    prose = ["stay at home. The rest", "look at rivers. It was late", "met at noon. Then we left", "was at sea. He sang", "and 300 400 5000 of them"]
    mails = ["jane{} (at) host{} (dot) com", "jane{}[at]host{}.org", "jane{} at host{} dot net", "JANE{} (AT) HOST{} (DOT) COM"]
    rows = [f"write to user{i}@mail.example.com or call +1 (212) 535-01{i:02d} today" for i in range(60)]
    rows += [f"so we {prose[i % 5]}" for i in range(500)]
    rows += ["please email " + mails[i % 4].format(i, i) for i in range(20)]
    rows += [f"tel. (0{i}1) 5350 1{i:02d}7 today" for i in range(10, 20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    shown = {i: [rows[i][int(a) : int(b)] for _, a, b in (s.split(":") for s in t.split(",") if s)] for i, t in got.items()}
    assert not any(shown[i] for i in range(60, 560))
    assert [shown[560 + i] for i in range(20)] == [[mails[i % 4].format(i, i)] for i in range(20)]
    assert [shown[580 + i] for i in range(10)] == [[f"(0{i}1) 5350 1{i:02d}7"] for i in range(10, 20)]


def test_a_lone_planted_span_is_added():
    base, lone, prose = (0, 1, 1, 1, 0, 1), (0, 0, 1, 1, 0, 1), (0, 0, 1, -1, 0, -1)
    likely = pii.reliabilities({base: 60, lone: 1, prose: 500})
    assert likely[base] > 0.9 and likely[lone] > 0.9 and likely[prose] < 0.1


def test_odd_rows_and_no_rows(odd_documents, no_documents):
    rows = pii.find(odd_documents).collect()
    assert len(rows) == odd_documents.count() and {r.spans for r in rows} == {""}
    assert pii.find(no_documents).count() == 0


def shown(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    return [[t[int(a) : int(b)] for _, a, b in (s.split(":") for s in got[i].split(",") if s)] for i, t in enumerate(rows)]


def test_listed_endings_in_prose_are_not_added(spark):
    real = [f"mail person{i}@site{i % 7}.org now" for i in range(100)]
    got = shown(spark, ["he was at store.com today"] * 100 + real + ["write to jo (at) site (dot) org soon"] * 5)
    assert got[:100] == [[]] * 100
    assert all(len(x) == 1 for x in got[100:200]) and got[200:] == [["jo (at) site (dot) org"]] * 5
    assert shown(spark, ["he was at store.com today"] * 100) == [[]] * 100
    assert shown(spark, ["he was at store.com today"] * 100 + real[:1])[:100] == [[]] * 100


def test_groups_of_digits_are_no_phones_without_a_word_for_it(spark):
    prose = ["totals 0312 455 600 units"] * 300
    assert shown(spark, prose) == [[]] * 300
    got = shown(spark, prose + [f"call +49 30 123 {i:04d} now" for i in range(100)] + ["phone 0312 455 601 today"] * 10)
    assert got[:300] == [[]] * 300 and all(len(x) == 1 for x in got[300:400])
    assert got[400:] == [["0312 455 601"]] * 10


def test_a_vote_for_is_never_evidence_against():
    # the form votes against whatever the others vote for, as it would if its sign were wrong
    counts = {(0, 0, 1, 1, 1, -1): 500, (0, 0, -1, -1, -1, 1): 500, (0, 0, 1, 1, 1, 1): 5, (0, 0, -1, -1, -1, -1): 5}
    likely = pii.reliabilities(counts)
    assert likely[(0, 0, 1, 1, 1, 1)] >= likely[(0, 0, 1, 1, 1, -1)]
    assert likely[(0, 0, -1, -1, -1, 1)] >= likely[(0, 0, -1, -1, -1, -1)]


def test_words_around_decide_between_equal_votes():
    base, same = (1, 1, 1, 0, 1), (0, 1, 1, 0, 1)
    rows = [pii.Example(0, base, 3, (1, n % 9, 5), 1) for n in range(200)]
    rows += [pii.Example(0, (0, 1, -1, 0, -1), 3, (2, n % 9, 6), 1) for n in range(200)]
    likely = {(0, *base): 1.0, (0, 0, 1, -1, 0, -1): 0.0}
    made = pii.fit(rows, likely)
    assert made.likely(0, same, 3, (1, 4, 5)) > made.likely(0, same, 3, (2, 4, 6))


def test_no_span_starts_inside_a_longer_run():
    assert [c[:3] for c in pii.candidates("x" * 64 + " (at) host.org")] == [(0, 0, 78)]
    assert pii.candidates("x" * 65 + " (at) host.org") == []
