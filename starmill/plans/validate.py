"""The checks a star must pass, from its declared columns and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.config import StarConfig
from starmill.operators import quality
from starmill.operators.keys import Lookup
from starmill.plans.build import keep_categories
from starmill.plans.star import CATEGORY, DIMENSIONS, ENTITY, FACT, IDS, MEASURE, TABLES, Star, declared

GRAIN = ("id_tiempo", "id_entidad", "id_delito")


def foreign_keys(star: Star) -> list[Lookup]:
    return [Lookup(star.tables()[name], IDS[name], {IDS[name]: IDS[name]}, name != ENTITY) for name in DIMENSIONS]


def orphans(star: Star) -> DataFrame:
    return quality.orphans(star.fact_victimas, foreign_keys(star))


def orphans_by_key(star: Star) -> DataFrame:
    return quality.orphans_by_key(star.fact_victimas, foreign_keys(star))


def unique_keys(star: Star) -> DataFrame:
    """Primary keys, and the entities' natural key. The fact's ids are dense, so bits count them."""
    checks = [quality.unique(star.tables()[name], [IDS[name]], f"{name}.{IDS[name]}") for name in DIMENSIONS]
    checks.append(quality.unique_number(star.fact_victimas, F.col(IDS[FACT]), f"{FACT}.{IDS[FACT]}"))
    checks.append(quality.unique(star.dim_entidad, ["clave_entidad"], f"{ENTITY}.clave_entidad"))
    return quality.union(checks)


def unique_grain(star: Star) -> DataFrame:
    """Fact rows beyond the first of a grain. The three ids are dense, so one number holds them; it
    runs through entities and categories within a period, as the stored fact does."""
    fact = star.fact_victimas
    time, entity, category = (F.col(c) for c in GRAIN)
    entities, categories = (fact.agg(F.max(c).cast("bigint")).scalar() for c in GRAIN[1:])
    number = ((time.cast("bigint") - 1) * entities + entity - 1) * categories + category
    return quality.unique_number(fact, number, f"{FACT}.grain")


def required(table: str) -> list[str]:
    return [c for c, _, _, nullable in declared(table) if not nullable]


def limits(table: str) -> dict[str, int]:
    return {c: n for c, _, n, _ in declared(table) if n}


def not_null(star: Star) -> DataFrame:
    return quality.union([quality.not_null(table, required(name), name) for name, table in star.tables().items()])


def max_length(star: Star) -> DataFrame:
    return quality.union([quality.max_length(table, limits(name), name) for name, table in star.tables().items()])


def coverage(star: Star, config: StarConfig) -> DataFrame:
    """Entities that the region catalogue lacks, and leaves that the category catalogue lacks."""
    regions = config.regions if isinstance(config.regions, DataFrame) else list(config.regions)
    return quality.union(
        [
            quality.coverage(star.dim_entidad, "nombre_entidad", regions, f"{ENTITY}.nombre_entidad in catalogue"),
            quality.coverage(star.dim_delito, "subtipo_delito", config.categories, f"{CATEGORY}.subtipo_delito in catalogue"),
        ]
    )


def source_total(wide: DataFrame, star: Star, config: StarConfig) -> DataFrame:
    """The catalogue's rows of the raw source against the fact."""
    return quality.sum_reconcile(
        MEASURE, keep_categories(wide, config), config.months, star.fact_victimas, MEASURE
    )


def constraints(star: Star) -> DataFrame:
    """Every constraint of the declared tables as one report.

    A table's row-wise checks (NULLs, text lengths) share one pass. Nothing shuffles the fact's rows:
    its ids are counted in bitmaps, its foreign keys per key value.
    """
    checks = [unique_keys(star), unique_grain(star), orphans_by_key(star)]
    for name, table in star.tables().items():
        tests = quality.null_tests(required(name), name) | quality.length_tests(limits(name), name)
        checks.append(quality.failing_rows(table, tests))
    return quality.union(checks)
