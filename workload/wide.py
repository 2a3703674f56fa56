"""A wide monthly source derived from the order tables, and its star.

Every shipped line counts its quantity in the month of its ship date; the supplier is the
entity, so the star grows with the tables, the part type is the category, and the return flag
the detail that the star drops.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.config import Category, StarConfig
from starmill.operators.skew import join_hot
from starmill.plans.build import build_grain, build_star
from starmill.plans.load import load_star
from starmill.plans.star import Star
from starmill.presets import MONTHS, SOURCE_COLUMNS
from starmill.session import scratch_path

CATEGORIES = {
    "ECONOMY": Category("A", True),
    "PROMO": Category("A", True),
    "LARGE": Category("B", True),
    "MEDIUM": Category("C", False),
    "SMALL": Category("C", False),
}
FLAGGED_YEARS = frozenset({2000, 2001})
SOURCE_LABEL = "lineitem"
LEAF = "PROMO"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of entity name and region."""
    supplier, nation, region = (table(spark, sf_dir, name) for name in ("supplier", "nation", "region"))
    placed = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return placed.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_name", "r_name")


def config(spark: SparkSession, sf_dir: str) -> StarConfig:
    return StarConfig(
        **SOURCE_COLUMNS,
        categories=CATEGORIES,
        regions=regions(spark, sf_dir),
        flagged_years=FLAGGED_YEARS,
        source_label=SOURCE_LABEL,
        entity_key_type="bigint",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines with their category, and their quantity in the column of their month."""
    lineitem, part = (table(spark, sf_dir, name) for name in ("lineitem", "part"))
    lines = join_hot(lineitem, part.select("p_partkey", "p_type"), {"l_partkey": "p_partkey"}).select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        "p_type",
        "l_returnflag",
        F.month("l_shipdate").alias("month"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    cells = [F.when(F.col("month") == i, F.col("quantity")).alias(m) for i, m in enumerate(MONTHS, 1)]
    return lines.select("l_suppkey", "year", "p_type", "l_returnflag", *cells)


def _named(lines: DataFrame) -> DataFrame:
    """Lines with their supplier under the wide source's column names, the supplier as entity."""
    c = SOURCE_COLUMNS
    return lines.select(
        F.col("year").alias(c["year"]),
        F.col("s_suppkey").alias(c["entity_key"]),
        F.col("s_name").alias(c["entity_name"]),
        F.substring("p_type", 1, 1).alias(c["good"]),
        F.substring("p_type", 1, 3).alias(c["kind"]),
        F.col("p_type").alias(c["leaf"]),
        F.col("l_returnflag").alias(c["detail"][0]),
        *MONTHS,
    )


def wide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shipped line as its own wide row, one month filled: the source at full size."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return _named(join_hot(_lines(spark, sf_dir), supplier, {"l_suppkey": "s_suppkey"}))


def wide_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table: one row per id and detail combination, NULL in months without a line.

    Lines are summed before suppliers are joined, so a supplier with very many lines is a few
    rows by then.
    """
    keys = ("l_suppkey", "year", "p_type", "l_returnflag")
    summed = _lines(spark, sf_dir).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MONTHS])
    return _named(summed.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")))


@dataclass(frozen=True)
class Built:
    grain: DataFrame
    star: Star


_built: dict[tuple[str, str], Built] = {}


def build(spark: SparkSession, sf_dir: str) -> Built:
    """Build and load the star for one set of tables."""
    conf = config(spark, sf_dir)
    grain = build_grain(wide_source(spark, sf_dir), conf)
    return Built(grain, load_star(build_star(grain, conf), scratch_path(spark, "star")))


def built(spark: SparkSession, sf_dir: str) -> Built:
    """The star of `sf_dir`, loaded once per application, as queries run on a loaded star."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(spark, sf_dir)
    return _built[key]
