"""Targets, the splitting tree and the drawn words against their definitions."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import mixing, queries


def brute_targets(sizes, weights, most=3):
    """Hand out a little at a time is too slow; fill up from the source that is full first."""
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    left, out = float(sum(sizes)), [0.0] * len(sizes)
    for n, i in enumerate(order):
        share = left * weights[i] / sum(weights[j] for j in order[n:])
        out[i] = min(share, most * sizes[i])
        left -= out[i]
    return out


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rng = np.random.default_rng(seed)
    sizes = [int(x) for x in rng.integers(0, 1000, 12) ** 2]
    weights = [(5, 2, 1)[i % 3] for i in range(12)]
    got = mixing.targets(sizes, weights)
    assert got == pytest.approx(brute_targets(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s for t, s in zip(got, sizes))


def test_targets_without_words():
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [5, 2]) == [0, 0]


def test_leaves_split_every_quota_exactly():
    quotas = np.array([1000, 3, 0, 77, 412])
    for shards in (1, 2, 7, 64):
        ends = np.zeros_like(quotas)
        many = []
        for shard in range(shards):
            first, have = mixing.leaf(quotas, shards, shard, 7)
            assert (first == ends).all()
            ends = first + have
            many.append(int(have.sum()))
        assert (ends == quotas).all() and max(many) - min(many) <= 6


def test_every_epoch_takes_every_block_once():
    for blocks in (1, 2, 9, 64):
        for epoch in range(3):
            assert sorted(mixing.permuted(4, epoch * blocks + i, blocks, 7) for i in range(blocks)) == list(range(blocks))


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_query(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    names = sorted(sizes)
    goals = dict(zip(names, brute_targets([sizes[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    got = {r.doc_id: r for r in queries.op8_mixing(spark, sf_dir).collect()}
    again = {r.doc_id: r for r in queries.op8_mixing(spark, sf_dir).collect()}
    assert got == again and len(got) == len(rows)
    took, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        row = got[r.doc_id]
        assert (row["size"], row.source_size) == (words(r.text), sizes[r.source])
        assert row.target == pytest.approx(goals[r.source])
        assert row.taken in (0, row["size"], 2 * row["size"], 3 * row["size"])
        took[r.source] += row.taken
        largest[r.source] = max(largest[r.source], row["size"])
    for name in names:
        assert abs(took[name] - goals[name]) <= largest[name] / 2 + 1


def test_mixed_rows_are_the_taken_ones(odd_documents, documents):
    for docs in (documents, odd_documents):
        mix = mixing.plan(docs, shards=5)
        want = Counter()
        for r in mixing.taken(mix).collect():
            want[r.doc_id] += r.copies
        rows = mixing.mixed(docs, mix)
        assert set(rows.columns) == {*docs.columns, "shard"}
        got = Counter(r.doc_id for r in rows.select("doc_id").collect())
        assert got == +want


def test_shards_are_spread_and_shuffled(documents):
    rows = mixing.mixed(documents, mixing.plan(documents, shards=5)).select("doc_id", "shard").collect()
    assert {r["shard"] for r in rows} == set(range(5))
    ids = [r.doc_id for r in rows if r["shard"] == 2]
    assert ids != sorted(ids)


def test_no_rows(no_documents):
    mix = mixing.plan(no_documents)
    assert mixing.taken(mix).count() == 0 and mixing.mixed(no_documents, mix).count() == 0


def test_a_column_that_differs_from_shard_in_case_only(odd_documents):
    docs = odd_documents.drop("shard", "size").withColumns({"Shard": F.lit("mine"), "SIZE": F.lit("mine")})
    rows = mixing.mixed(docs, mixing.plan(docs))
    assert rows.columns == docs.columns
    assert {(r["Shard"], r["SIZE"]) for r in rows.select("Shard", "SIZE").collect()} <= {("mine", "mine")}


def brute_drawn(sized, sources, seed):
    """Draws and open blocks, block by block."""
    have = Counter()
    by_name = {s.name: s for s in sources}
    for r in sized.withColumn("block", F.xxhash64(F.lit("block"), "key")).collect():
        s = by_name[r.source]
        have[s.place, r.block % s.blocks] += r["size"]
    out = {}
    for s in sources:
        epochs = int(s.target // s.size) if s.size else 0
        left, draws = s.target - epochs * s.size, epochs * s.blocks
        while left > 0 and draws < (epochs + 1) * s.blocks:
            left -= have[s.place, mixing.permuted(s.place, draws, s.blocks, seed)]
            draws += 1
        out[s.place] = draws
    return out


@pytest.mark.parametrize("ranges", [1, 3, 4096])
def test_the_block_where_a_target_is_reached(documents, odd_documents, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGES", ranges)
    for docs in (documents, odd_documents):
        mix = mixing.plan(docs, weights=(5, 2, 1, 0.1), shards=5)
        assert {s.place: s.draws for s in mix.sources} == brute_drawn(mix.sized, mix.sources, mix.seed)


def test_blocks_too_many_to_broadcast(documents, monkeypatch):
    mix = mixing.plan(documents, shards=5)
    want = sorted(mixing.taken(mix).collect()), Counter(mixing.mixed(documents, mix).select("doc_id", "shard").collect())
    monkeypatch.setattr(mixing, "BROADCAST_BLOCKS", 0)
    assert "BroadcastHashJoin [place" not in mixing.taken(mix)._jdf.queryExecution().optimizedPlan().toString()
    assert (sorted(mixing.taken(mix).collect()), Counter(mixing.mixed(documents, mix).select("doc_id", "shard").collect())) == want


@pytest.mark.parametrize("words", [10**10, 10**11, 10**13, 10**15])
def test_every_shard_has_every_source_at_any_size(words):
    share = np.array([0.33, 0.3, 0.2, 0.1, 0.05, 0.0195, 0.0005])
    sizes = [int(words * s) for s in share]
    goal = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    shards = mixing.shards_for(sum(goal))
    blocks = mixing.blocks_for([n // 200 for n in sizes], shards)
    quotas = np.array([int(b * t / n) for b, t, n in zip(blocks, goal, sizes)])
    documents = np.array([n // 200 // mixing.DOCS_PER_BLOCK for n in sizes])
    assert (np.array(blocks) >= np.minimum(documents, mixing.BLOCKS_PER_SHARD * shards)).all()
    enough = quotas >= 24 * shards
    assert enough.sum() >= 3
    for shard in range(0, shards, max(1, shards // 50)):
        assert (mixing.leaf(quotas, shards, shard, 7)[1][enough] > 0).all()
