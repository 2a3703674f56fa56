"""Data-quality checks.

A check returns rows (check, violations, status); reconciliations add what they compared.
Checks are lazy and each reads its input once, so a report is one union of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.keys import Lookup
from starmill.operators.skew import join_hot
from starmill.session import materialise

OK, MISMATCH = "OK", "MISMATCH"


class QualityError(ValueError):
    """A report contains a check that is not OK."""


def fail_on_violation(report: DataFrame) -> DataFrame:
    """Raise if any check failed. The report holds one row per check."""
    failed = report.where(F.col("status") != OK).collect()
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))
    return report


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def count_reconcile(expected: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each expected table against the loaded one."""
    return union(
        [
            _reconciled(name, table.agg(F.count("*").alias("expected")), loaded[name].agg(F.count("*").alias("loaded")))
            for name, table in expected.items()
        ]
    )


def row_total(measures: Sequence[str]) -> Column:
    """Sum over the measure columns of a row, empty ones as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{m}`"), F.lit(0)).cast("bigint") for m in measures])


def counts_against(expected: Mapping[str, int], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Known row counts against the loaded tables'."""
    return union(
        [_against(name, n, loaded[name].agg(F.count("*").alias("loaded"))) for name, n in expected.items()]
    )


def total_against(name: str, expected: int, loaded: DataFrame, measure: str) -> DataFrame:
    """A known total against that of the loaded column."""
    return _against(name, expected, loaded.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("loaded")))


def sum_reconcile(
    name: str, source: DataFrame, measures: Sequence[str], loaded: DataFrame, measure: str
) -> DataFrame:
    """Total over all measure columns of the raw source against the total of the loaded column.

    It compares with the source before any reshaping, so rows lost or multiplied on the way
    show up.
    """
    total = F.coalesce(F.sum(row_total(measures)), F.lit(0)).alias("expected")
    return _reconciled(name, source.agg(total), loaded.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("loaded")))


def missing_keys(fact: DataFrame, lookup: Lookup) -> DataFrame:
    """`key` and `rows`: the fact's key values that the dimension lacks, NULL among them, with their rows.

    The fact is counted per key before anything is joined, so a key with very many rows is one.
    """
    (mine, theirs) = next(iter(lookup.on.items()))
    counts = fact.groupBy(F.col(mine).alias("key")).agg(F.count("*").alias("rows"))
    known = lookup.table.select(F.col(theirs).alias("_known")).distinct()
    return counts.join(known, F.col("key") == F.col("_known"), "left_anti")


def orphans(fact: DataFrame, lookups: Sequence[Lookup], name: str = "orphans") -> DataFrame:
    """Fact rows that miss at least one dimension, each counted once."""
    return _one(name, _missing(fact, lookups).select(F.col("any").alias("violations")))


def orphans_by_key(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Fact rows without a match, one row per dimension."""
    keys = [next(iter(lookup.on)) for lookup in lookups]
    rows = [F.struct(F.lit(key).alias("check"), F.col(f"n{i}").alias("violations")) for i, key in enumerate(keys)]
    long = _missing(fact, lookups).select(F.inline(F.array(*rows)))
    return long.withColumn("status", F.when(F.col("violations") == 0, OK).otherwise(MISMATCH))


#: Most rows of an id bitmap, each 64 ids wide, that are broadcast: some 64 MB.
BITMAP_WORDS = 1 << 20
_WORD_BITS = 6


def id_bitmap(table: DataFrame, key: str) -> DataFrame:
    """Which whole numbers a column holds: `word` (number / 64) and `bits`. It merges: partial ones are OR-ed."""
    value = F.col(f"`{key}`").cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(value, F.lit(1 << _WORD_BITS)).cast("int"))
    numbers = table.where(value.isNotNull()).select(F.shiftright(value, _WORD_BITS).alias("word"), bit.alias("bit"))
    return numbers.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _missing(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """One row: fact rows that miss any dimension (`any`), and those that miss the i-th (`n0`, `n1`, ...).

    The fact is read once. Each of its ids is looked up in a bitmap of the dimension's, which has a
    row per 64 dense ids and is broadcast while it has at most BITMAP_WORDS; the fact's rows then stay
    where they are, however often a key occurs. A dimension beyond that, or one whose keys are no
    whole numbers, is joined by its keys, hot ones apart (`join_hot`), on rows that carry one number each.
    A NULL id is missing.
    """
    rows = fact.select(*(F.col(f"`{next(iter(lookup.on))}`").alias(f"k{i}") for i, lookup in enumerate(lookups)))
    for i, lookup in enumerate(lookups):
        theirs = next(iter(lookup.on.values()))
        whole = all(isinstance(t, T.IntegralType) for t in (rows.schema[f"k{i}"].dataType, lookup.table.schema[theirs].dataType))
        bitmap = id_bitmap(lookup.table, theirs) if whole else None
        if whole and (lookup.bounded or bitmap.count() <= BITMAP_WORDS):
            named = bitmap.select(F.col("word").alias(f"w{i}"), F.col("bits").alias(f"b{i}"))
            id = F.col(f"k{i}").cast("bigint")
            rows = rows.join(F.broadcast(named), F.shiftright(id, _WORD_BITS) == F.col(f"w{i}"), "left").drop(f"w{i}")
            at = F.pmod(id, F.lit(1 << _WORD_BITS)).cast("int")
            rows = rows.withColumn(f"m{i}", F.coalesce(F.getbit(F.col(f"b{i}"), at) == 0, F.lit(True))).drop(f"b{i}")
        else:
            rows = _tested_by_join(rows, f"k{i}", lookup.table.select(F.col(f"`{theirs}`").alias("_known")), f"m{i}")
    flags = [F.col(f"m{i}") for i in range(len(lookups))]
    counts = [F.count_if(reduce(lambda a, b: a | b, flags)).alias("any")]
    return rows.agg(*counts, *(F.count_if(flag).alias(f"n{i}") for i, flag in enumerate(flags)))


def _tested_by_join(rows: DataFrame, key: str, known: DataFrame, out: str) -> DataFrame:
    """`rows`, written, with whether `known` lacks their `key`."""
    rows = materialise(rows, "tested")
    hits = join_hot(rows, known.distinct(), {key: "_known"}).drop("_known").withColumn(out, F.lit(False))
    absent = materialise(missing_keys(rows, Lookup(known, "", {key: "_known"})).select(F.col("key").alias("_absent")), "absent")
    lost = join_hot(rows, absent, {key: "_absent"}, "left_semi").unionByName(rows.where(F.col(key).isNull()))
    return hits.unionByName(lost.withColumn(out, F.lit(True)))


def unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Key values held by more than one row. Counts are combined before the shuffle."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return _one(name, repeated.agg(F.count("*").alias("violations")))


def unique_number(df: DataFrame, number: Column, name: str) -> DataFrame:
    """Rows beyond the first of each value of a whole number that is dense; NULLs do not count.

    Values are counted in bitmaps, one bit each, so what is shuffled is a few bytes per hundred rows.
    """
    numbers = df.select(number.cast("bigint").alias("_v")).where("_v IS NOT NULL")
    bits = numbers.groupBy(F.bitmap_bucket_number("_v").alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("_bits"), F.count("*").alias("_n")
    )
    surplus = F.sum(F.col("_n") - F.bitmap_count("_bits"))
    return _one(name, bits.agg(F.coalesce(surplus, F.lit(0)).cast("bigint").alias("violations")))


def null_tests(columns: Sequence[str], table: str) -> dict[str, Column]:
    return {f"{table}.{c}": F.col(f"`{c}`").isNull() for c in columns}


def length_tests(limits: Mapping[str, int], table: str) -> dict[str, Column]:
    return {f"{table}.{c} length": F.char_length(F.col(f"`{c}`")) > n for c, n in limits.items()}


def not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """NULLs per column."""
    return failing_rows(df, null_tests(columns, table))


def max_length(df: DataFrame, limits: Mapping[str, int], table: str) -> DataFrame:
    """Texts longer than the column allows."""
    return failing_rows(df, length_tests(limits, table))


def failing_rows(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Rows for which each test is true, all tests in one pass."""
    counted = df.agg(*[F.count_if(test).alias(f"_{i}") for i, test in enumerate(tests.values())])
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(tests)]
    long = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.check", "r.violations")
    return long.withColumn("status", F.when(F.col("violations") == 0, OK).otherwise(MISMATCH))


def coverage(df: DataFrame, column: str, catalogue: Iterable[str] | DataFrame, name: str) -> DataFrame:
    """Distinct values of `column` that a list, or a DataFrame's first column, does not hold."""
    values = df.select(F.col(f"`{column}`").alias("_value")).where("_value IS NOT NULL").distinct()
    if isinstance(catalogue, DataFrame):
        known = catalogue.select(F.col(f"`{catalogue.columns[0]}`").alias("_key"))
        unknown = values.join(known, F.col("_value") == F.col("_key"), "left_anti")
    else:
        unknown = values.where(~F.col("_value").isin(*catalogue))
    return _one(name, unknown.agg(F.count("*").alias("violations")))


def _one(name: str, count: DataFrame) -> DataFrame:
    status = F.when(F.col("violations") == 0, OK).otherwise(MISMATCH)
    return count.select(F.lit(name).alias("check"), "violations", status.alias("status"))


def _against(name: str, expected: int, loaded: DataFrame) -> DataFrame:
    status = F.when(F.col("loaded") == expected, OK).otherwise(MISMATCH)
    return loaded.select(
        F.lit(name).alias("check"), F.lit(expected).cast("bigint").alias("expected"), "loaded", status.alias("status")
    )


def _reconciled(name: str, expected: DataFrame, loaded: DataFrame) -> DataFrame:
    status = F.when(F.col("expected") == F.col("loaded"), OK).otherwise(MISMATCH)
    return expected.withColumn("loaded", loaded.scalar()).select(
        F.lit(name).alias("check"), "expected", "loaded", status.alias("status")
    )
