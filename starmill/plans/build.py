"""Transform: wide rows to grain, grain to dimensions, grain and dimensions to fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.config import StarConfig
from starmill.functions.scalars import describe, lookup, part_of_year, period_label
from starmill.operators.keys import (
    Lookup,
    dense_key,
    number_placed,
    place_in_order,
    require_unique,
    resolve_keys,
)
from starmill.operators.reshape import keep_listed, sum_periods, unpivot_periods
from starmill.plans.star import CATEGORY, ENTITY, FACT, MEASURE, SMALLINT_VALUES, TIME, Star, conform
from starmill.session import materialise

# The grain's keys. Ids are given in this order, months within their id group.
LEVELS = ("bien_juridico", "tipo_delito", "subtipo_delito")
ID_KEYS = ("anio", "clave_entidad", "nombre_entidad", *LEVELS)
GRAIN_KEYS = (*ID_KEYS, "mes", "nombre_mes")


def keep_categories(wide: DataFrame, config: StarConfig) -> DataFrame:
    """Source rows whose leaf category is in the catalogue."""
    return keep_listed(wide, config.leaf, config.categories)


def summed(wide: DataFrame, config: StarConfig) -> DataFrame:
    """Month columns summed per entity, leaf and year, under the star's column names."""
    named = dict(zip(config.ids, ID_KEYS, strict=True))
    renamed = keep_categories(wide, config).select(
        *[F.col(f"`{source}`").alias(name) for source, name in named.items()],
        *[F.col(f"`{month}`").cast("bigint").alias(month) for month in config.months],
    )
    types = {"anio": "smallint", "clave_entidad": config.entity_key_type}
    return sum_periods(renamed, ID_KEYS, config.months).select(
        *[F.col(k).cast(types.get(k, "string")) for k in ID_KEYS], *config.months
    )


def by_month(sums: DataFrame, config: StarConfig, *kept: str) -> DataFrame:
    """One row per id group and month. `kept` are the id columns to carry along."""
    long = unpivot_periods(sums, kept, config.months, "nombre_mes", MEASURE, "mes")
    return long.withColumn("mes", F.col("mes").cast("smallint"))


def rolled_up(wide: DataFrame, config: StarConfig) -> DataFrame:
    """Measure at the grain entity x leaf x month."""
    return by_month(summed(wide, config), config, *ID_KEYS)


def build_grain(wide: DataFrame, config: StarConfig) -> DataFrame:
    """The grain in key order with its months side by side, written once.

    The dimensions and the fact read it. Every id group has every month, so the order and
    number of its months are known without sorting or storing one row for each.
    """
    return place_in_order(summed(wide, config), ID_KEYS)


def numbered_after(new: DataFrame, order: list[str], id: str, bound: int | None, stored: DataFrame | None) -> DataFrame:
    """Ids for `new` in `order`, going on after the largest stored one."""
    last = 0 if stored is None else stored.agg(F.max(id)).first()[0] or 0
    return dense_key(new, order, id, bound).withColumn(id, F.col(id) + F.lit(last))


def unknown(found: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose natural key the stored dimension lacks."""
    return found if stored is None else found.join(stored.select(*keys), keys, "left_anti")


def build_time(grain: DataFrame, config: StarConfig, stored: DataFrame | None = None) -> DataFrame:
    """Periods of the grain, or those that the stored ones lack."""
    months = F.array(*[F.struct(F.lit(i), F.lit(m)) for i, m in enumerate(config.months, 1)])
    periods = grain.select("anio").distinct().select("anio", F.inline(months).alias("mes", "nombre_mes"))
    year, month = F.col("anio"), F.col("mes")
    periods = unknown(periods, stored, ["anio", "mes"])
    bound = SMALLINT_VALUES * len(config.months)
    described = numbered_after(periods, ["anio", "mes"], "id_tiempo", bound, stored).select(
        "*",
        part_of_year(month, 3).alias("trimestre"),
        part_of_year(month, 6).alias("semestre"),
        period_label(year, month).alias("periodo_label"),
        year.isin(*config.flagged_years).alias("es_anio_pandemia"),
    )
    return conform(described, TIME)


def build_entity(grain: DataFrame, config: StarConfig, stored: DataFrame | None = None) -> DataFrame:
    """Entities by natural key, or those that the stored ones lack. A name without a region gets NULL,
    which a check reports."""
    entities = unknown(grain.select("clave_entidad", "nombre_entidad").distinct(), stored, ["clave_entidad"])
    bound = SMALLINT_VALUES if config.entity_key_type == "smallint" else None
    numbered = numbered_after(entities, ["clave_entidad"], "id_entidad", bound, stored)
    if isinstance(config.regions, DataFrame):
        regions = config.regions.toDF("_name", "region")
        placed = numbered.join(regions, F.col("nombre_entidad") == F.col("_name"), "left")
    else:
        placed = numbered.withColumn("region", lookup(F.col("nombre_entidad"), config.regions))
    return conform(placed, ENTITY, clave_entidad=config.entity_key_type)


def build_category(grain: DataFrame, config: StarConfig, stored: DataFrame | None = None) -> DataFrame:
    """Hierarchy leaves in the order they first appear in the sorted grain, or those that the stored ones lack.

    The grain's slots follow its key order, so the first appearance is the smallest slot: a
    minimum that is combined before the shuffle. Leaves come from the driver-side catalogue,
    which bounds their number.
    """
    first = unknown(grain.groupBy(*LEVELS).agg(F.min("_slot").alias("_first")), stored, ["subtipo_delito"])
    leaf = F.col("subtipo_delito")
    described = numbered_after(first, ["_first"], "id_delito", len(config.categories), stored).select(
        "*",
        lookup(leaf, {k: c.name for k, c in config.categories.items()}).alias("categoria"),
        lookup(leaf, {k: c.flagged for k, c in config.categories.items()}).alias("es_letal"),
        describe(F.col("tipo_delito"), leaf).alias("descripcion"),
    )
    return conform(described, CATEGORY)


def build_fact(
    grain: DataFrame, time: DataFrame, entity: DataFrame, category: DataFrame, config: StarConfig, last: int = 0
) -> DataFrame:
    """Number the grain in key order, after the id `last`, and replace natural keys by dimension ids.

    Entities and categories are resolved per id group, before it becomes twelve rows.
    """
    groups = resolve_keys(
        number_placed(grain, "_group"),
        [
            Lookup(entity, "id_entidad", {"clave_entidad": "clave_entidad"}),
            Lookup(category, "id_delito", {"subtipo_delito": "subtipo_delito"}),
        ],
    )
    rows = by_month(groups, config, "_group", "anio", "id_entidad", "id_delito")
    numbered = rows.withColumn("id_hecho", (F.col("_group") - 1) * len(config.months) + F.col("mes") + F.lit(last))
    keyed = resolve_keys(numbered, [Lookup(time, "id_tiempo", {"anio": "anio", "mes": "mes"})])
    filled = keyed.withColumns(
        {
            MEASURE: F.coalesce(MEASURE, F.lit(0)),
            "fuente": F.lit(config.source_label),
            "fecha_carga": F.current_timestamp(),
        }
    )
    return conform(filled, FACT, **{MEASURE: config.measure_type})


def require_lookup_keys(grain: DataFrame, config: StarConfig, stored: Star | None = None) -> None:
    """The fact resolves entities by key and leaves by name alone, so both must be unique, together
    with the stored ones if there are any.

    Checked before the dimensions are built: their bounds on rows hold only for unique keys.
    """
    if isinstance(config.regions, DataFrame):
        require_unique(config.regions, config.regions.columns[:1], "regions")
    named = (("clave_entidad", "nombre_entidad"), ENTITY, "clave_entidad"), (LEVELS, CATEGORY, "subtipo_delito")
    for columns, table, key in named:
        found = grain.select(*columns)
        if stored is not None:
            found = found.unionByName(stored.tables()[table].select(*columns))
        require_unique(found.distinct(), [key], table)


def build_star(grain: DataFrame, config: StarConfig, stored: Star | None = None) -> Star:
    """All four tables from a grain made by `build_grain`; with a `stored` star the rows it lacks.

    The dimensions are written before the fact is joined to them: they are built once, and
    their sizes are known when Spark chooses how to join. The stored dimensions are the index of
    the natural keys: known ones keep their ids, new ones go on after the largest.
    """
    require_lookup_keys(grain, config, stored)
    made, whole = [], []
    for build, name in ((build_time, TIME), (build_entity, ENTITY), (build_category, CATEGORY)):
        before = stored.tables()[name] if stored else None
        new = materialise(build(grain, config, before), build.__name__)
        made.append(new)
        whole.append(before.unionByName(new) if stored else new)
    last = stored.fact_victimas.agg(F.max("id_hecho")).first()[0] or 0 if stored else 0
    return Star(*made, build_fact(grain, *whole, config, last))
