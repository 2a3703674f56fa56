"""Sinks: full refresh published as a new version, plain appends, result export."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.plans import versions
from starmill.plans.star import DIMENSIONS, FACT, TABLES, YEAR, Star
from starmill.session import materialise


#: Between a result's path and a unique ending, while a new result takes its place.
_ASIDE = ".aside-"


def load_star(star: Star, base: str, check: Callable[[Star], object] | None = None) -> Star:
    """Replace the star stored under `base` and return it as read back.

    The four tables go to a new directory, dimensions first, and `check` sees them as written;
    only then is a version published that names that directory. Readers see the old star or the
    new one, and a load that fails or is refused changes nothing. A load that was published since
    this one began is not overwritten: that raises `PublishConflict`.
    """
    spark = star.fact_victimas.sparkSession
    number = versions.next_number(spark, base)
    target = new_part(base, number)
    append_star(star, target)
    loaded = read_tables(spark, target)
    if check:
        check(loaded)
    versions.publish(spark, base, number, (target,))
    return loaded


def new_part(base: str, number: int) -> str:
    return f"{base}/v{number}-{uuid.uuid4().hex[:8]}"


def append_star(star: Star, path: str) -> None:
    """Append every table under `path`, dimensions first.

    The fact goes in period order, so each file and row group covers few periods and a time
    slice skips the others. Time ids are dense, so a row's place follows from its id: nothing is
    sampled and the fact is evaluated once. Its files lie in one folder per year, so a filter on
    time reads the folders of its years only; a row of an unknown period lies in a folder of its own.
    """
    parts = int(star.fact_victimas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, periods = star.dim_tiempo.agg(F.min("id_tiempo"), F.count(F.lit(1))).first()
    for name in DIMENSIONS:
        star.tables()[name].write.mode("append").parquet(f"{path}/{name}")
    # a calendar has at most twelve rows for each value of a SMALLINT
    years = F.broadcast(star.dim_tiempo.select("id_tiempo", F.col("anio").cast("int").alias(YEAR)))
    fact = star.fact_victimas.drop(YEAR).join(years, "id_tiempo", "left").select(*star.fact_victimas.drop(YEAR).columns, YEAR)
    writer = in_period_order(fact, max(1, periods), parts, first or 1, YEAR).write.mode("append")
    # without periods there are no rows and no folders, and a file must say what the columns are
    (writer.partitionBy(YEAR) if periods else writer).parquet(f"{path}/{FACT}")


def in_period_order(fact: DataFrame, periods: int, parts: int, first: int = 1, *before: str) -> DataFrame:
    """About `parts` partitions of neighbouring periods, counted from id `first`; a period larger than one is several, by hash.

    Rows are sorted by the columns `before`, then by period and id.
    """
    slices = max(1, parts // periods)
    period = F.col("id_tiempo").cast("bigint") - first
    if slices > 1:
        place, parts = period * slices + F.pmod(F.xxhash64("id_hecho"), F.lit(slices)), periods * slices
    else:
        place, parts = F.floor(period * F.lit(min(parts, periods)) / F.lit(periods)), min(parts, periods)
    dealt = fact.repartitionById(parts, F.pmod(F.coalesce(place, F.lit(0)), F.lit(parts)).cast("int"))
    return dealt.sortWithinPartitions(*before, "id_tiempo", "id_hecho")


def append_jdbc(
    star: Star, url: str, schema: str, batch_rows: int = 1000, connections: int = 8, **properties: str
) -> None:
    """Append every table to a database, dimensions first, in batches of `batch_rows`.

    The database fills the fact's id and load time from its own defaults. At most `connections`
    tasks write at once; tables are written to the shared folder first, so that bounds the
    connections and not the work before them.
    """
    for name, table in star.tables().items():
        sent = table.drop("id_hecho", "fecha_carga", YEAR) if name == FACT else table
        writer = materialise(sent, name).write.mode("append")
        writer = writer.option("batchsize", batch_rows).option("numPartitions", connections)
        writer.jdbc(url, f"{schema}.{name}", properties=properties)


def read_star(spark: SparkSession, base: str) -> Star:
    """The current star under `base`."""
    return read_tables(spark, *published(spark, base).parts)


def read_tables(spark: SparkSession, *parts: str) -> Star:
    """A star whose tables lie in one folder or several; each has a fact with years of its own."""
    tables = {name: spark.read.parquet(*(f"{part}/{name}" for part in parts)) for name in DIMENSIONS}
    facts = [spark.read.parquet(f"{part}/{FACT}") for part in parts]
    return Star(**tables, fact_victimas=reduce(DataFrame.unionByName, facts))


def register_tables(spark: SparkSession, base: str, database: str) -> None:
    """Make the current star under `base` addressable as `database`.table in SQL text.

    A star of one folder becomes tables, one with appended folders becomes views over them.
    """
    parts = published(spark, base).parts
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full):
            kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {full}")
        if len(parts) == 1:
            spark.catalog.createTable(full, f"{parts[0]}/{name}", "parquet")
            if name == FACT and spark.read.parquet(f"{parts[0]}/{name}").inputFiles():
                spark.catalog.recoverPartitions(full)
        else:
            union = " UNION ALL ".join(f"SELECT * FROM parquet.`{part}/{name}`" for part in parts)
            spark.sql(f"CREATE VIEW {full} AS {union}")


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV in its order: quoted header, CRLF line ends, NULL as an empty field.

    For results a dashboard reads: a report-sized one is one file. The file is complete before it
    takes the place of an earlier one, which a failed export leaves as it was.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    _restore(spark, path)
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"nullValue": ""})
    lines = materialise(df.select(F.monotonically_increasing_id().alias("at"), line.alias("value")), "export")
    header = F.lit(",".join('"' + c.replace('"', '""') + '"' for c in df.columns))
    first = lines.agg(F.min("at")).first()[0]
    if first is None:
        text = spark.range(1).select(header.alias("value"))
    else:
        headed = F.when(F.col("at") == first, F.array(header, "value")).otherwise(F.array("value"))
        text = lines.orderBy("at").select(F.explode(headed).alias("value"))
    fresh = f"{path}.{uuid.uuid4().hex}"
    text.write.text(fresh, lineSep="\r\n")
    _replace(spark, fresh, path)


def _move(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _restore(spark: SparkSession, path: str) -> None:
    """Bring back a result that an export had set aside when its process ended."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        left = system.globStatus(hadoop.Path(f"{path}{_ASIDE}*"))
        if left:
            _move(system, left[0].getPath(), place)


def _replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder `fresh` in the place of `path`: the earlier one is set aside, and deleted last.

    If the second step fails the first is undone; if the process ends between them the next export undoes it.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, old, aside = hadoop.Path(fresh), hadoop.Path(path), hadoop.Path(f"{path}{_ASIDE}{uuid.uuid4().hex}")
    system = new.getFileSystem(spark._jsc.hadoopConfiguration())
    had = system.exists(old)
    if had:
        _move(system, old, aside)
    else:
        system.mkdirs(old.getParent())
    try:
        _move(system, new, old)
    except BaseException:
        if had:
            _move(system, aside, old)
        raise
    if had:
        system.delete(aside, True)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove all but the newest `keep` published versions under `base`, once no reader needs them.

    Folders that a kept version names stay, as those of the loads that it was appended to.
    """
    return versions.forget(spark, base, keep)


def published(spark: SparkSession, base: str) -> versions.Version:
    current = versions.current(spark, base)
    if current is None:
        raise FileNotFoundError(f"no star has been published under {base}")
    return current
