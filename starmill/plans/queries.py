"""The named questions over a star, as thin uses of the operators.

Each returns a DataFrame in the order the question asks for. Where names decide it, `collation` names
the rules they are compared by, such as `es`; without one they are compared by code point.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.scalars import collated
from starmill.operators.analytics import (
    change_from_previous,
    percentiles,
    percentiles_approx,
    rank_within,
    share_where,
    top_n,
    totals,
)
from starmill.plans.star import CATEGORY, MEASURE, TIME, Star

MONTHLY_PERCENTILES = {"mediana_mensual": 0.5, "p90_mensual": 0.9}


def table_counts(star: Star) -> DataFrame:
    """Rows per table."""
    counts = [
        table.agg(F.count("*").alias("registros")).select(F.lit(name).alias("tabla"), "registros")
        for name, table in star.tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


def rank_by_period(star: Star, leaf: str, total: str = "total_feminicidios", collation: str | None = None) -> DataFrame:
    """Entities ranked by one leaf category, year by year."""
    sums = star.per_entity(TIME, CATEGORY, by=["anio"], where=F.col("subtipo_delito") == leaf)
    yearly = totals(sums, ["nombre_entidad", "anio"], MEASURE, total)
    # A year ranks each entity once; the dimension's row count comes from file footers.
    entities = star.dim_entidad.count()
    ranked = rank_within(yearly, ["anio"], ["nombre_entidad"], total, "ranking_anual", entities)
    return ranked.orderBy("anio", "ranking_anual", collated("nombre_entidad", collation))


def flagged_by_year(star: Star) -> DataFrame:
    """Total of the flagged categories per entity and year."""
    sums = star.per_entity(TIME, CATEGORY, by=["anio"], where=F.col("es_letal"))
    return totals(sums, ["nombre_entidad", "anio"], MEASURE, "total")


def yoy_change(star: Star, consecutive: bool = False, collation: str | None = None) -> DataFrame:
    """Change of the flagged categories from year to year, per entity."""
    changed = change_from_previous(
        flagged_by_year(star),
        ["nombre_entidad"],
        "anio",
        "total",
        "anio_anterior",
        "variacion_absoluta",
        "pct_cambio",
        consecutive,
    )
    return changed.orderBy(F.desc_nulls_last("pct_cambio"), collated("nombre_entidad", collation), "anio")


def lethal_share(star: Star, collation: str | None = None) -> DataFrame:
    """Share of the flagged categories in each entity's total."""
    shares = share_where(
        star.per_entity(CATEGORY, by=["es_letal"]),
        ["nombre_entidad"],
        MEASURE,
        F.col("es_letal"),
        "total_delitos",
        "delitos_letales",
        "pct_letal",
    )
    return shares.orderBy(F.desc_nulls_first("pct_letal"), collated("nombre_entidad", collation))


def percentile_by_group(star: Star) -> DataFrame:
    """Median, 90th percentile and maximum of the fact rows of each leaf category."""
    rows = star.joined(CATEGORY).select("subtipo_delito", MEASURE)
    spread = percentiles(rows, ["subtipo_delito"], MEASURE, MONTHLY_PERCENTILES, largest="maximo_mensual")
    return spread.orderBy(F.desc_nulls_first("p90_mensual"), "subtipo_delito")


def percentile_approx_by_group(star: Star, accuracy: int = 10_000) -> DataFrame:
    """Like `percentile_by_group` from one sketch per category, nearest rank instead of interpolation."""
    rows = star.joined(CATEGORY)
    spread = percentiles_approx(rows, ["subtipo_delito"], MEASURE, MONTHLY_PERCENTILES, accuracy)
    return spread.orderBy(F.desc_nulls_first("p90_mensual"), "subtipo_delito")


def map_totals(star: Star, total: str = "total_victimas", collation: str | None = None) -> DataFrame:
    """Total per entity with its region."""
    by_entity = totals(star.per_entity(), ["nombre_entidad", "region"], MEASURE, total)
    return by_entity.orderBy(F.desc_nulls_first(total), collated("nombre_entidad", collation))


def top_n_total(star: Star, n: int = 10, collation: str | None = None) -> DataFrame:
    """The entities with the largest totals."""
    by_entity = totals(star.per_entity(), ["nombre_entidad", "region"], MEASURE, "total_acumulado")
    return top_n(by_entity, "total_acumulado", n, [collated("nombre_entidad", collation)])


def by_month(star: Star, leaf: str) -> DataFrame:
    rows = star.joined(TIME, CATEGORY).where(F.col("subtipo_delito") == leaf)
    return totals(rows, ["anio", "mes", "nombre_mes"], MEASURE, "total_mensual")


def by_year_and_category(star: Star) -> DataFrame:
    return totals(star.joined(TIME, CATEGORY), ["anio", "subtipo_delito"], MEASURE, "total_victimas")


def monthly_series(star: Star, leaf: str) -> DataFrame:
    """Month by month total of one leaf category."""
    return by_month(star, leaf).orderBy("anio", "mes")


def yearly_by_category(star: Star, collation: str | None = None) -> DataFrame:
    """Total per year and leaf category."""
    return by_year_and_category(star).orderBy("anio", collated("subtipo_delito", collation))
