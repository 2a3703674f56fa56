"""The operators' distributed forms against plain ones, with ties, NULLs and hot groups."""

import math
import random
import struct
import sys
from decimal import Context, Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.scalars import percent
from starmill.operators import analytics
from starmill.operators.analytics import (
    of_words,
    percentiles,
    percentiles_approx,
    rank_within,
    share_where,
    top_n,
    with_words,
)
from starmill.operators.keys import Lookup, dense_key, resolve_keys
from starmill.operators.reshape import keep_listed, rollup_long, rollup_wide, unpivot_periods

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def hot_rows(n, span, seed=7):
    """One group holds a third of the rows, one value a third of that group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        value = 0 if i % 9 == 0 else rng.randrange(-span, span)
        rows.append((group, i, value))
    return rows


@pytest.mark.parametrize("broadcast_rows", [analytics.BROADCAST_ROWS, 0], ids=["broadcast", "joined"])
@pytest.mark.parametrize("kind, span", [("smallint", 300), ("int", 2_000_000_000), ("bigint", 2**63)])
def test_percentiles_are_exact(spark, monkeypatch, kind, span, broadcast_rows):
    monkeypatch.setattr(analytics, "BROADCAST_ROWS", broadcast_rows)
    rows = hot_rows(3000, span) + [("g1", -1, None), ("empty", -2, None)]
    df = spark.createDataFrame(rows, f"g string, i int, v {kind}")
    wanted = {"low": 0.0, "mid": 0.5, "p90": 0.9, "high": 1.0}
    found = {r.g: r for r in percentiles(df, ["g"], "v", wanted, largest="top").collect()}
    groups = {}
    for g, _, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for g, values in groups.items():
        values.sort()
        for out, p in wanted.items():
            place = p * (len(values) - 1)
            low, high = values[int(np.floor(place))], values[int(np.ceil(place))]
            assert found[g][out] == pytest.approx(low + (place - np.floor(place)) * (high - low), rel=1e-12, abs=1e-9)
        assert found[g].top == values[-1]
    assert set(found) == {*groups, "empty"}
    assert found["empty"].asDict() == {"g": "empty", **dict.fromkeys(wanted), "top": None}


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_percentiles_of_a_group_do_not_depend_on_others(spark, kind):
    rows = [(f"g{i % 300}", i * 7919 % 1000) for i in range(3000)]
    far = {"smallint": 30_000, "int": 2_000_000_000, "bigint": 2**62}[kind]
    wanted = {"a": 0.37, "p90": 0.9}
    alone, beside = (
        {r.g: r for r in percentiles(spark.createDataFrame(x, f"g string, v {kind}"), ["g"], "v", wanted).collect()}
        for x in (rows, [*rows, ("far", far)])
    )
    assert all(beside[g] == r for g, r in alone.items())


def test_percentiles_of_decimals_are_exact(spark):
    values = [Decimal(v) for v in ("-3.75", "0.01", "2.50", "99999999.99", "7.00")]
    df = spark.createDataFrame([("a", v) for v in values] + [("none", None)], "g string, v decimal(12,2)")
    rows = {r.g: r for r in percentiles(df, ["g"], "v", {"low": 0.25, "mid": 0.5}, largest="top").collect()}
    assert (rows["a"].low, rows["a"].mid, rows["a"].top) == (0.01, 2.5, Decimal("99999999.99"))
    assert (rows["none"].low, rows["none"].top) == (None, None)


def test_percentile_of_five_with_null(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, None)], "g string, v int")
    row = percentiles(df, ["g"], "v", {"mid": 0.5, "p90": 0.9}).first()
    assert (row.mid, row.p90) == (2.5, 3.7)


def test_percentiles_keep_a_null_group_and_no_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 9)], "g string, v int")
    assert {r.g: r.mid for r in percentiles(df, ["g"], "v", {"mid": 0.5}).collect()} == {None: 2.0, "a": 9.0}


def test_percentiles_refuse_text(spark):
    with pytest.raises(TypeError):
        percentiles(spark.range(1).select(F.lit("a").alias("g"), F.lit("x").alias("v")), ["g"], "v", {"mid": 0.5})


INF, NAN = float("inf"), float("nan")
DOUBLES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1, 0), math.nextafter(1, 2)]
DOUBLES += [-1.5, 1e300, -1e300, sys.float_info.max, -sys.float_info.max, INF, -INF, 0.1, 1 / 3, 8.0, math.nextafter(8, 0), 2.0**52 + 0.5]


def test_words_of_doubles_keep_value_and_order(spark):
    rng = random.Random(7)
    bits = [struct.unpack("<d", struct.pack("<q", rng.getrandbits(64) - (1 << 63)))[0] for _ in range(3000)]
    values = DOUBLES + [b for b in bits if b == b]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    words, names = with_words(df.select("v", F.col("v").alias("m")), ["v"], "m")
    rows = words.select("v", names[0], of_words([F.col(names[0])], T.DoubleType()).alias("back")).collect()
    assert all(r.back == r.v for r in rows)
    ordered = sorted(rows, key=lambda r: r._word0)
    assert [r.v for r in ordered] == sorted(r.v for r in rows)
    assert len({r._word0 for r in rows}) == len({r.v for r in rows})


def test_percentiles_of_doubles(spark):
    values = sorted(v for v in DOUBLES if abs(v) < 1e200)
    rows = [("a", v) for v in values] + [("nan", NAN), ("nan", 1.0), ("nan", -3.0), ("inf", INF), ("inf", INF), ("null", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r for r in percentiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "p90": 0.9}, largest="top").collect()}
    at = 0.9 * (len(values) - 1)
    lower, upper = values[math.floor(at)], values[math.ceil(at)]
    assert found["a"].low == values[0] and found["a"].mid == values[len(values) // 2] and found["a"].top == values[-1]
    assert found["a"].p90 == lower + (at - math.floor(at)) * (upper - lower)
    assert found["nan"].mid == 1.0 and math.isnan(found["nan"].top) and math.isnan(found["nan"].p90)
    assert found["inf"][1:] == (INF, INF, INF, INF)
    assert found["null"][1:] == (None, None, None, None)


def test_percentiles_of_floats(spark):
    df = spark.createDataFrame([("a", float(i) / 3) for i in range(101)], "g string, v float")
    row = percentiles(df, ["g"], "v", {"mid": 0.5}, largest="top").first()
    wide = df.select(F.col("v").cast("double").alias("v"))
    assert row.mid == wide.orderBy("v").collect()[50].v and row.top == df.agg(F.max("v")).first()[0]


@pytest.mark.parametrize("kind", ["decimal(38,0)", "decimal(38,10)", "decimal(30,5)", "decimal(38,38)", "decimal(19,2)"])
def test_percentiles_of_wide_decimals(spark, kind):
    rng = random.Random(3)
    digits, scale = (int(x) for x in kind[8:-1].split(","))
    whole = [rng.randrange(-(10**digits) + 1, 10**digits) for _ in range(301)]
    whole += [10**digits - 1, -(10**digits) + 1, 0, -1, 1, 1 << 64, -(1 << 64), (1 << 64) - 1, -(1 << 63)]
    whole = [w for w in whole if abs(w) < 10**digits]
    values = sorted(Decimal(w).scaleb(-scale, Context(prec=60)) for w in whole)
    df = spark.createDataFrame([("a", v) for v in values], f"g string, v {kind}")
    row = percentiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5}, largest="top").first()
    middle = (len(values) - 1) / 2
    expected = (float(values[math.floor(middle)]) + float(values[math.ceil(middle)])) / 2
    assert row.top == values[-1]
    assert math.isclose(row.low, float(values[0]), rel_tol=1e-15)
    assert math.isclose(row.mid, expected, rel_tol=1e-12)


def test_approximate_percentiles_stay_in_their_bound(spark):
    n, accuracy = 20_000, 100
    df = spark.range(n).select(F.lit("a").alias("g"), F.xxhash64("id").alias("h")).orderBy("h")
    df = df.select("g", F.row_number().over(Window.orderBy("h")).alias("v"))
    row = percentiles_approx(df, ["g"], "v", {"mid": 0.5, "p90": 0.9}, accuracy).first()
    assert abs(row.mid - 0.5 * n) <= n / accuracy + 1
    assert abs(row.p90 - 0.9 * n) <= n / accuracy + 1


@pytest.mark.parametrize("span", [1, 2, 50, 10**6])
def test_ranks_of_a_spread_group_equal_a_window(spark, span):
    rows = hot_rows(3000, span) + [("hot", -n, None) for n in range(1, 400)] + [("none", -n, None) for n in range(5)]
    df = spark.createDataFrame(rows, "g string, i int, v bigint")
    spread = rank_within(df, ["g"], ["i"], "v", "r")
    window = rank_within(df, ["g"], ["i"], "v", "r", max_group=4000)
    assert spread.schema == window.schema
    as_rows = lambda d: sorted(map(tuple, d.select("g", "i", "v", "r").collect()), key=str)
    assert as_rows(spread) == as_rows(window)


def test_operators_work_without_groups(spark):
    df = spark.createDataFrame([(i, i * 100_000 % 7_000_000) for i in range(200)], "i int, v int")
    values = sorted(r.v for r in df.collect())
    assert percentiles(df, [], "v", {"mid": 0.5}, largest="top").collect() == [((values[99] + values[100]) / 2, values[-1])]
    ranks = {r.v: r.r for r in rank_within(df, [], ["i"], "v", "r").collect()}
    assert ranks[values[-1]] == 1 and ranks[values[0]] == 1 + sum(v > values[0] for v in values)


def test_spread_ranks_use_no_window_over_a_whole_group(spark):
    df = spark.createDataFrame(hot_rows(90, 50), "g string, i int, v bigint")
    plan = rank_within(df, ["g"], ["i"], "v", "r")._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.splitlines() if "[rank(" in line]
    assert ranks and all("_range" in line.split("[rank(")[1] for line in ranks)


def test_dense_keys_have_no_gaps_in_either_form(spark):
    df = spark.range(5000).select((F.xxhash64("id") % 7).alias("a"), F.col("id").alias("b"))
    large = {(r.a, r.b): r.k for r in dense_key(df, ["a", "b"], "k").collect()}
    small = {(r.a, r.b): r.k for r in dense_key(df, ["a", "b"], "k", max_rows=5000).collect()}
    assert large == small
    assert sorted(large.values()) == list(range(1, 5001))


def test_numbering_does_not_shuffle_the_rows(spark):
    df = spark.range(100)
    plan = dense_key(df, ["id"], "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_resolve_keys_keeps_unmatched_rows(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([(10, "a")], "did int, name string")
    found = resolve_keys(facts, [Lookup(dim, "did", {"k": "name"})])
    assert {r.id: r.did for r in found.collect()} == {1: 10, 2: None, 3: None}
    assert found.columns == ["id", "k", "did"]


def test_top_n_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "n string, v int")
    top = top_n(df, "v", 2, ["n"])
    assert [r.n for r in top.collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_percent_is_decimal_and_safe_on_zero(spark):
    df = spark.createDataFrame([(13, 208), (-13, 208), (1, 3), (5, 0)], "a bigint, b bigint")
    found = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert [None if v is None else float(v) for v in found] == [6.3, -6.3, 33.3, None]


def test_catalogue_forms_agree_and_the_list_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.concat(F.lit("k"), F.col("id") % 9).alias("k"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    listed = keep_listed(df, "k", ["k1", "k4"])
    joined = keep_listed(df, "k", spark.createDataFrame([("k1",), ("k4",), ("k4",)], "key string"))
    assert sorted(listed.collect()) == sorted(joined.collect())
    assert "PushedFilters: [In(k" in listed._jdf.queryExecution().executedPlan().toString()


def test_unpivot_keeps_nulls_and_prunes_periods(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.createDataFrame([("a", 1, None, 3)], "k string, p int, q int, r int").write.parquet(path)
    long = unpivot_periods(spark.read.parquet(path), ["k"], ["p", "q"], "name", "v", "pos")
    assert [tuple(r) for r in long.collect()] == [("a", "p", 1, 1), ("a", "q", None, 2)]
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string,p:int,q:int>" in plan


CELLS = st.one_of(st.none(), st.integers(-1000, 1000))
WIDE = st.lists(st.tuples(st.sampled_from(["a", "b", None]), CELLS, CELLS, CELLS), min_size=1, max_size=30)


@FEW
@given(rows=WIDE)
def test_both_rollup_orders_agree_and_keep_the_total(spark, rows):
    periods = ["p", "q", "r"]
    df = spark.createDataFrame(rows, "k string, p bigint, q bigint, r bigint")
    first = rollup_wide(df, ["k"], periods, "name", "v", "pos")
    long = unpivot_periods(df, ["k"], periods, "name", "v", "pos")
    second = rollup_long(long, ["k", "pos", "name"], "v")
    as_set = lambda d: sorted(map(tuple, d.select("k", "pos", "name", "v").collect()))
    assert as_set(first) == as_set(second)
    kept = sum(v or 0 for k, *cells in rows if k for v in cells)
    assert sum(r[3] for r in as_set(first)) == kept


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from("abc"), st.booleans(), st.integers(0, 10**9)), min_size=1, max_size=30))
def test_shares_lie_between_0_and_100(spark, rows):
    df = spark.createDataFrame(rows, "g string, f boolean, v bigint")
    for r in share_where(df, ["g"], "v", F.col("f"), "total", "part", "pct").collect():
        assert r.pct is None or 0 <= r.pct <= 100
        assert (r.part is None) == (not any(f for g, f, _ in rows if g == r.g))


@FEW
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_every_group_has_a_first_rank(spark, values):
    df = spark.createDataFrame([(i % 3, i, v) for i, v in enumerate(values)], "g int, i int, v int")
    ranked = rank_within(df, ["g"], ["i"], "v", "r").collect()
    assert len(ranked) == len(values)
    assert {r.g for r in ranked if r.r == 1} == {i % 3 for i in range(len(values))}


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["p", "q", "r", None]), CELLS), max_size=30))
def test_rollup_across_equals_the_plain_one(spark, rows):
    long = spark.createDataFrame(rows, "k string, name string, v bigint")
    plain = rollup_long(long, ["k", "name"], "v")
    across = rollup_long(long, ["k", "name"], "v", across=("name", ["p", "q", "r"]))
    assert across.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(tuple, across.collect())) == sorted(map(tuple, plain.collect()))


def test_rollup_across_raises_for_an_unlisted_value(spark):
    long = spark.createDataFrame([("a", "p", 1), ("a", "s", 2)], "k string, name string, v bigint")
    with pytest.raises(Exception, match="no listed value: s"):
        rollup_long(long, ["k", "name"], "v", across=("name", ["p", "q"])).collect()


def test_unpivot_first_shuffles_a_row_per_id_group(spark, sf_dir):
    """Once twelve rows per id group, each with all keys, went through the shuffle."""
    from workload import raw

    plan = raw.grain_rollup_unpivot_first(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    top = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "nombre_mes" not in top.split("], [")[0] and "Expand" in plan
