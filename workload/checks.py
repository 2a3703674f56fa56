"""Data-quality queries on stars and tables that are known to break the rule in question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators import quality
from starmill.plans import validate
from starmill.plans.star import ENTITY, TIME, Star, without
from starmill.presets import MONTHS, SOURCE_COLUMNS
from starmill.session import materialise
from workload.wide import CATEGORIES, built, config, regions, table, wide_source


def _without_dimension_rows(star: Star) -> Star:
    """The star after losing one region's entities and the flagged years' months."""
    return without(without(star, ENTITY, "region = 'ASIA'"), TIME, "es_anio_pandemia")


def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = built(spark, sf_dir).star
    return quality.count_reconcile(star.tables(), _without_dimension_rows(star).tables())


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.orphans(_without_dimension_rows(built(spark, sf_dir).star))


def orphans_by_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.orphans_by_key(_without_dimension_rows(built(spark, sf_dir).star))


def sum_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's source rows against the fact (equal), then all source rows (not)."""
    star, wide = built(spark, sf_dir).star, wide_source(spark, sf_dir)
    unfiltered = quality.sum_reconcile("unfiltered", wide, MONTHS, star.fact_victimas, "num_victimas")
    return validate.source_total(wide, star, config(spark, sf_dir)).unionByName(unfiltered)


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's keys, and two keys of the order tables."""
    lines = quality.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem.line")
    orders = quality.unique(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders.o_orderkey")
    return quality.union([validate.unique_keys(built(spark, sf_dir).star), orders, lines])


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's required columns, and the wide source's month cells, some of which are empty."""
    cells = quality.not_null(wide_source(spark, sf_dir), MONTHS, "wide")
    return validate.not_null(built(spark, sf_dir).star).unionByName(cells)


def length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's text limits, and limits that some documents and parts exceed."""
    documents = quality.max_length(table(spark, sf_dir, "documents"), {"text": 200, "source": 80}, "documents")
    part = quality.max_length(table(spark, sf_dir, "part"), {"p_name": 10}, "part")
    return quality.union([validate.max_length(built(spark, sf_dir).star), documents, part])


def grain_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's grain, and the same rule on shipped lines, where it does not hold."""
    lines = quality.unique(
        table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey", "l_returnflag"], "lineitem.grain"
    )
    return validate.unique_grain(built(spark, sf_dir).star).unionByName(lines)


def catalog_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities against a catalogue that lacks one region; leaves against the categories."""
    wide = wide_source(spark, sf_dir)
    known = regions(spark, sf_dir).where("r_name <> 'ASIA'").select("s_name")
    return quality.union(
        [
            quality.coverage(wide, SOURCE_COLUMNS["entity_name"], known, "region"),
            quality.coverage(wide, SOURCE_COLUMNS["leaf"], CATEGORIES, "category"),
        ]
    )


def validated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All constraints of the loaded star; a violation raises instead of being logged."""
    report = materialise(validate.constraints(built(spark, sf_dir).star), "report")
    return quality.fail_on_violation(report).groupBy("status").agg(F.count("*").alias("checks"))
