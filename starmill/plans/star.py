"""The star: three dimensions and one fact table, and the ways queries address it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.skew import join_hot

TIME, ENTITY, CATEGORY, FACT = "dim_tiempo", "dim_entidad", "dim_delito", "fact_victimas"

# Load order: dimensions before the fact.
DIMENSIONS = (TIME, ENTITY, CATEGORY)
TABLES = (*DIMENSIONS, FACT)

IDS = {TIME: "id_tiempo", ENTITY: "id_entidad", CATEGORY: "id_delito", FACT: "id_hecho"}

MEASURE = "num_victimas"

# A stored fact lies in one folder per year, which reading shows as this column.
YEAR = "anio_hecho"

# A SMALLINT column (years, months, declared entity keys) has no more distinct values than this.
SMALLINT_VALUES = 65_536

# Declared columns per table: name, Spark type, longest text (VARCHAR), may be NULL.
COLUMNS = {
    TIME: (
        ("id_tiempo", "int", None, False),
        ("anio", "smallint", None, False),
        ("mes", "smallint", None, False),
        ("nombre_mes", "string", 20, False),
        ("trimestre", "smallint", None, False),
        ("semestre", "smallint", None, False),
        ("periodo_label", "string", 10, False),
        ("es_anio_pandemia", "boolean", None, False),
    ),
    ENTITY: (
        ("id_entidad", "int", None, False),
        ("clave_entidad", "smallint", None, False),
        ("nombre_entidad", "string", 60, False),
        ("region", "string", 30, False),
    ),
    CATEGORY: (
        ("id_delito", "int", None, False),
        ("bien_juridico", "string", 80, False),
        ("tipo_delito", "string", 80, False),
        ("subtipo_delito", "string", 80, False),
        ("categoria", "string", 50, False),
        ("es_letal", "boolean", None, False),
        ("descripcion", "string", 200, True),
    ),
    FACT: (
        ("id_hecho", "bigint", None, False),
        ("id_tiempo", "int", None, False),
        ("id_entidad", "int", None, False),
        ("id_delito", "int", None, False),
        ("num_victimas", "int", None, False),
        ("fuente", "string", 100, True),
        ("fecha_carga", "timestamp", None, True),
    ),
}


def conform(df: DataFrame, table: str, **types: str) -> DataFrame:
    """Project to the declared columns and types of `table`; `types` overrides single ones."""
    return df.select(
        *[F.col(name).cast(types.get(name, kind)).alias(name) for name, kind, _, _ in COLUMNS[table]]
    )


@dataclass(frozen=True)
class Star:
    dim_tiempo: DataFrame
    dim_entidad: DataFrame
    dim_delito: DataFrame
    fact_victimas: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def joined(self, *dimensions: str) -> DataFrame:
        """The fact inner-joined with the named dimensions.

        Entities may be many and one of them may hold much of the fact, so hot entity ids are split
        off. The other dimensions are bounded by the calendar and the catalogue. A stored fact is
        joined with time on its year too, so a comparison with any attribute of time leaves out, at run
        time, the folders of years that it does not keep (Spark expects nothing of a bare flag).
        """
        wide = self.fact_victimas
        if TIME not in dimensions and YEAR in wide.columns:
            wide = wide.drop(YEAR)
        if ENTITY in dimensions:
            wide = named_entities(wide, self.dim_entidad)
        for name in dimensions:
            if name == TIME and YEAR in wide.columns:
                dated = self.dim_tiempo.withColumn(YEAR, F.col("anio").cast("int"))
                wide = wide.join(dated, [IDS[TIME], YEAR], "inner").drop(YEAR)
            elif name != ENTITY:
                wide = wide.join(getattr(self, name), IDS[name], "inner")
        return wide

    def per_entity(self, *dimensions: str, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """The measure summed per entity and `by`, beside the entity's columns.

        The other named dimensions are bounded by the calendar and the catalogue and are
        joined, and filtered by `where`, before the sum. Entities may be many and one of them
        may hold much of the fact, so the sum is taken per entity id first and the entity's
        columns are joined to the sums, which a further SUM can group as it likes.
        """
        rows = self.joined(*dimensions)
        if where is not None:
            rows = rows.where(where)
        sums = rows.groupBy(IDS[ENTITY], *by).agg(F.sum(MEASURE).alias(MEASURE))
        return sums.join(self.dim_entidad, IDS[ENTITY])

    def sliced(self, first: str, last: str) -> Star:
        """The star limited to the periods `first`..`last` (labels like `2023-03`, inclusive).

        Time ids are dense in period order, so the slice is a range of ids. The range comes
        from two scalar subqueries over the time dimension and is pushed down to the fact
        scan, which skips row groups because the fact is written in period order. The range of
        years of a stored fact is found alike and names the folders that are read.
        """
        kept = self.dim_tiempo.where(F.col("periodo_label").between(first, last))
        fact = self.fact_victimas
        for at, name in (("id_tiempo", "id_tiempo"), ("anio", YEAR)):
            if name in fact.columns:
                fact = fact.where(F.col(name).between(*(kept.agg(edge(at)).scalar() for edge in (F.min, F.max))))
        return replace(self, dim_tiempo=kept, fact_victimas=fact)

    def create_views(self, prefix: str = "") -> None:
        """Register the tables as temporary views for `spark.sql`."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(prefix + name)


def named_entities(rows: DataFrame, dim_entidad: DataFrame) -> DataFrame:
    """Fact rows beside their entity's columns."""
    key = IDS[ENTITY]
    slim = dim_entidad.withColumnRenamed(key, "_entity")
    return join_hot(rows, slim, {key: "_entity"}).drop("_entity")


def without(star: Star, table: str, condition: str) -> Star:
    """A star whose `table` lacks the rows matching `condition`."""
    return replace(star, **{table: star.tables()[table].where(f"NOT ({condition})")})


def declared(table: str) -> Sequence[tuple[str, str, int | None, bool]]:
    return COLUMNS[table]
