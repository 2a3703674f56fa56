"""Filter by catalogue, unpivot period columns, roll up to the grain."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.scalars import all_not_null, lookup
from starmill.operators.skew import join_hot


def keep_listed(df: DataFrame, column: str, catalogue: Iterable[str] | DataFrame) -> DataFrame:
    """Rows whose `column` is in the catalogue.

    A driver-side list becomes an IN predicate that reaches the file scan. A DataFrame whose
    first column holds the keys, each once or more, becomes a semi join in which hot keys are
    split off, see `join_hot`.
    """
    if not isinstance(catalogue, DataFrame):
        return df.where(F.col(f"`{column}`").isin(*catalogue))
    key = catalogue.columns[0]
    return join_hot(df, catalogue.select(F.col(f"`{key}`").alias("_listed")), {column: "_listed"}, "left_semi")


def unpivot_periods(
    df: DataFrame,
    ids: Sequence[str],
    periods: Sequence[str],
    name: str,
    measure: str,
    number: str | None = None,
) -> DataFrame:
    """One row per id row and period column; empty cells stay as NULL rows.

    Only `ids` and `periods` are read. Pass fewer periods to prune columns at the scan.
    `number` adds the 1-based position of the period.
    """
    long = df.unpivot(
        [F.col(f"`{c}`") for c in ids],
        [F.col(f"`{c}`") for c in periods],
        name,
        measure,
    )
    if number is None:
        return long
    positions = {period: position for position, period in enumerate(periods, 1)}
    return long.withColumn(number, lookup(F.col(name), positions))


def rollup_long(df: DataFrame, keys: Sequence[str], measure: str, across: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Sum to the grain. Rows with a NULL key do not count; a group of NULLs sums to 0.

    `across` names one of the keys and all values it can have, a few. Rows then meet by the other keys alone,
    with a sum per value side by side, so what is shuffled carries the other keys once for all values; only
    values that a group has become rows again. Any other value raises.
    """
    rows = df.where(all_not_null(keys))
    if across is None:
        return rows.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.coalesce(F.sum(measure), F.lit(0)).alias(measure))
    name, values = across
    ids = [F.col(f"`{c}`") for c in keys if c != name]
    # columns of the operator's own, which no key can clash with: they are taken apart by place
    sums = [F.sum(F.when(F.col(f"`{name}`") == v, F.col(f"`{measure}`"))).alias(f"_sum_{n}") for n, v in enumerate(values)]
    number = lookup(F.col(f"`{name}`"), {v: n for n, v in enumerate(values)})
    known = F.coalesce(number, F.raise_error(F.concat(F.lit(f"{name}: no listed value: "), F.col(f"`{name}`").cast("string"))).cast("int"))
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), known)).alias("_seen")
    wide = rows.groupBy(*ids).agg(seen, *sums)
    cells = [
        F.struct(F.lit(v).alias(name), F.coalesce(F.col(f"_sum_{n}"), F.lit(0)).alias(measure), (F.shiftright("_seen", n).bitwiseAND(F.lit(1)) == 1).alias("_has"))
        for n, v in enumerate(values)
    ]
    long = wide.select(*ids, F.inline(F.array(*cells))).where("_has")
    return long.select(*[F.col(f"`{c}`") for c in keys], F.col(f"`{measure}`"))


def sum_periods(df: DataFrame, ids: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """Sum each period column per id group, under the rules of `rollup_long`.

    Each source row is hashed once, not once per period, and each shuffled row carries its
    keys once for all periods. Partial sums absorb a hot id group before the shuffle.
    """
    sums = [F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).alias(c) for c in periods]
    return df.where(all_not_null(ids)).groupBy(*[F.col(f"`{c}`") for c in ids]).agg(*sums)


def rollup_wide(
    df: DataFrame,
    ids: Sequence[str],
    periods: Sequence[str],
    name: str,
    measure: str,
    number: str,
) -> DataFrame:
    """`unpivot_periods` then `rollup_long`, in the cheaper order: only grain rows are unpivoted."""
    return unpivot_periods(sum_periods(df, ids, periods), ids, periods, name, measure, number)
