"""Questions that build on the named ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.scalars import percent
from starmill.operators.analytics import percentiles, totals
from starmill.plans.queries import by_month, by_year_and_category, flagged_by_year, yearly_by_category
from starmill.plans.star import CATEGORY, ENTITY, IDS, MEASURE, TIME, Star, named_entities
from starmill.session import materialise


def growth_vs_total(star: Star) -> DataFrame:
    """Each entity's yearly percent change against that of all entities together.

    `por_encima` compares the two ratios by cross-multiplication, so it needs no rounding.
    It is NULL where either earlier total is missing or 0.
    """
    yearly = flagged_by_year(star)
    national = totals(yearly, ["anio"], "total", "total_nacional")
    # One row per year, and a year is a SMALLINT: few enough for one task and for a broadcast.
    national = national.withColumn("nacional_anterior", F.lag("total_nacional").over(Window.orderBy("anio")))
    by_entity = Window.partitionBy("nombre_entidad").orderBy("anio")
    both = yearly.withColumn("anio_anterior", F.lag("total").over(by_entity)).join(F.broadcast(national), "anio")

    now, before = F.col("total"), F.col("anio_anterior")
    all_now, all_before = F.col("total_nacional"), F.col("nacional_anterior")
    change, all_change = percent(now - before, before), percent(all_now - all_before, all_before)
    a, b, c, d = (x.cast("decimal(18,0)") for x in (now, before, all_now, all_before))
    faster = a * d > c * b
    # the difference of both ratios over one denominator, rounded last
    apart, product = (a - b) * d - (c - d) * b, b * d
    return both.select(
        "nombre_entidad",
        "anio",
        change.alias("pct_cambio"),
        all_change.alias("pct_nacional"),
        percent(apart, product).alias("diferencia"),
        F.when((before > 0) & (all_before > 0), faster).alias("por_encima"),
    ).orderBy(F.desc_nulls_last("diferencia"), "nombre_entidad", "anio")


def outlier_rows(star: Star, p: float = 0.9) -> DataFrame:
    """Fact rows above percentile `p` of their leaf category."""
    rows = star.joined(CATEGORY)
    limits = percentiles(rows.select("subtipo_delito", MEASURE), ["subtipo_delito"], MEASURE, {"umbral": p})
    # One limit per leaf of the driver-side catalogue. Rows are dropped before entities are joined.
    above = rows.join(F.broadcast(limits), "subtipo_delito").where(F.col(MEASURE) > F.col("umbral"))
    above = materialise(above.select("id_hecho", IDS[TIME], IDS[ENTITY], "subtipo_delito", MEASURE, "umbral"), "outliers")
    named = named_entities(above, star.dim_entidad).join(star.dim_tiempo, IDS[TIME])
    return named.select("id_hecho", "nombre_entidad", "periodo_label", "subtipo_delito", MEASURE, "umbral")


def sliced_yearly(star: Star, first: str, last: str) -> DataFrame:
    """`yearly_by_category` within a range of periods."""
    return yearly_by_category(star.sliced(first, last))


def region_totals(star: Star) -> DataFrame:
    by_region = totals(star.per_entity(), ["region"], MEASURE, "total_victimas")
    return by_region.orderBy(F.desc_nulls_first("total_victimas"), "region")


def flagged_split(star: Star) -> DataFrame:
    """Flagged years against the others: total, number of months, mean per month."""
    monthly = totals(star.joined(TIME), ["es_anio_pandemia", "anio", "mes"], MEASURE, "total")
    return (
        monthly.groupBy("es_anio_pandemia")
        .agg(
            F.sum("total").alias("total_victimas"),
            F.count("*").alias("meses"),
            F.avg("total").alias("promedio_mensual"),
        )
        .orderBy("es_anio_pandemia")
    )


def seasonality(star: Star, leaf: str) -> DataFrame:
    """Mean monthly total of one leaf category for each month of the year."""
    mean = F.avg("total_mensual").alias("promedio_mensual")
    return by_month(star, leaf).groupBy("mes", "nombre_mes").agg(mean).orderBy("mes")


def category_growth(star: Star) -> DataFrame:
    """Leaf categories ranked by growth from their first to their last year."""
    ends = (
        by_year_and_category(star)
        .groupBy("subtipo_delito")
        .agg(
            F.min("anio").alias("primer_anio"),
            F.max("anio").alias("ultimo_anio"),
            F.min_by("total_victimas", "anio").alias("total_inicial"),
            F.max_by("total_victimas", "anio").alias("total_final"),
        )
    )
    grown = ends.withColumn(
        "pct_crecimiento", percent(F.col("total_final") - F.col("total_inicial"), F.col("total_inicial"))
    )
    return grown.orderBy(F.desc_nulls_last("pct_crecimiento"), "subtipo_delito")
