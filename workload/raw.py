"""The analytic operators straight on the large tables, without a star in between."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.scalars import collated, lookup
from starmill.operators.analytics import (
    change_from_previous,
    percentiles,
    rank_within,
    share_where,
    totals,
)
from starmill.operators.keys import dense_key
from starmill.operators.reshape import keep_listed, rollup_long, rollup_wide, unpivot_periods
from starmill.presets import MONTHS, SOURCE_COLUMNS
from workload.wide import CATEGORIES, table, wide_lines

IDS = [SOURCE_COLUMNS[c] for c in ("year", "entity_key", "entity_name", "good", "kind", "leaf")]


MEDIAN_P90 = {"mediana": 0.5, "p90": 0.9}


def rounded(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Interpolated values to six decimals: engines differ in the last binary digit."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def cents(column: str) -> Column:
    """A two-decimal amount as whole cents, so sums do not depend on their order."""
    return F.rint(F.col(column) * 100).cast("bigint")


def quantity() -> Column:
    return F.col("l_quantity").cast("bigint").alias("quantity")


def rank_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers ranked by the amount of their filled orders, year by year."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    rows = orders.select("o_custkey", F.year("o_orderdate").alias("anio"), cents("o_totalprice").alias("cents"))
    yearly = totals(rows, ["o_custkey", "anio"], "cents", "total_cents")
    return rank_within(yearly, ["anio"], ["o_custkey"], "total_cents", "ranking_anual")


def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly change of the returned quantity of every part."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    rows = returned.select("l_partkey", F.year("l_shipdate").alias("anio"), quantity())
    yearly = totals(rows, ["l_partkey", "anio"], "quantity", "total")
    return change_from_previous(
        yearly, ["l_partkey"], "anio", "total", "anio_anterior", "variacion_absoluta", "pct_cambio"
    )


def lethal_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned share of every part's shipped quantity."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", quantity())
    returned = F.col("l_returnflag") == "R"
    return share_where(rows, ["l_partkey"], "quantity", returned, "total", "devuelto", "pct_devuelto")


def percentile_of_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price percentiles per return flag: three groups, each about a third of all lines.

    One line's price in cents is an INT; a larger one would fail the cast, not wrap.
    """
    price = cents("l_extendedprice").cast("int").alias("cents")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", price)
    return rounded(percentiles(rows, ["l_returnflag"], "cents", MEDIAN_P90, largest="maximo"), MEDIAN_P90)


def percentile_of_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity percentiles per return flag, on a measure whose type bounds its values."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("smallint").alias("units"))
    return rounded(percentiles(rows, ["l_returnflag"], "units", MEDIAN_P90, largest="maximo"), MEDIAN_P90)


def percentile_of_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price percentiles of a decimal measure; one return flag has no prices at all."""
    price = F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice").cast("decimal(15,2)"))
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", price.alias("precio"))
    found = percentiles(rows, ["l_returnflag", "l_linestatus"], "precio", MEDIAN_P90, largest="maximo")
    return rounded(found, MEDIAN_P90)


def percentile_of_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of a floating measure with values below zero, zeros of both signs and values that are no number."""
    margin = F.col("l_extendedprice") * (F.col("l_discount") - 0.05)
    kept = F.when(F.col("l_orderkey") % 97 == 0, float("nan")).when(F.col("l_orderkey") % 7 == 0, -0.0).otherwise(margin)
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", kept.alias("margen"))
    found = percentiles(rows, ["l_returnflag", "l_linestatus"], "margen", {"p10": 0.1, **MEDIAN_P90}, largest="maximo")
    shown = found.withColumn("sin_numero", F.isnan("maximo")).drop("maximo")
    return rounded(shown, ["p10", *MEDIAN_P90])


def percentile_of_wide_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of a decimal beyond 64 bits: prices in 10^-20 of a unit, some of them negative."""
    price = (F.col("l_extendedprice") * F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)).cast("decimal(15,2)")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", price.cast("decimal(36,20)").alias("precio"))
    return rounded(percentiles(rows, ["l_returnflag"], "precio", MEDIAN_P90, largest="maximo"), MEDIAN_P90)


def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned quantity month by month."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    rows = returned.select(F.year("l_shipdate").alias("anio"), F.month("l_shipdate").alias("mes"), quantity())
    series = totals(rows, ["anio", "mes"], "quantity", "total_mensual")
    names = dict(enumerate(MONTHS, 1))
    return series.withColumn("nombre_mes", lookup(F.col("mes"), names)).orderBy("anio", "mes")


def grain_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain of the line-level wide source, sums first, then unpivot."""
    return rollup_wide(wide_lines(spark, sf_dir), IDS, MONTHS, "nombre_mes", "num_victimas", "mes")


def grain_rollup_unpivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grain, unpivot first: twelve rows per line reach the aggregate.

    There they meet with their months side by side, so keys are shuffled once for twelve sums. The month's
    number follows from its name, so it is looked up on the sums.
    """
    long = unpivot_periods(wide_lines(spark, sf_dir), IDS, MONTHS, "nombre_mes", "num_victimas")
    sums = rollup_long(long, [*IDS, "nombre_mes"], "num_victimas", across=("nombre_mes", MONTHS))
    return sums.withColumn("mes", lookup(F.col("nombre_mes"), {m: i for i, m in enumerate(MONTHS, 1)}))


def filter_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part is in a catalogue that is itself a large table."""
    part = table(spark, sf_dir, "part")
    catalogue = keep_listed(part, "p_type", CATEGORIES).select("p_partkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return keep_listed(lines, "l_partkey", catalogue)


def collated_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First words of documents ranked per language by the rules of Spanish, last ones first."""
    word = F.regexp_extract("text", r"^\p{L}+", 0)
    words = table(spark, sf_dir, "documents").select("lang", word.alias("palabra")).where("lang IS NOT NULL AND palabra <> ''").distinct()
    keyed = words.withColumn("clave", collated("palabra", "es"))
    return rank_within(keyed, ["lang"], ["palabra"], "clave", "lugar").drop("clave")


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered 1..n by customer and order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dense_key(orders, ["o_custkey", "o_orderkey"], "id_orden")
