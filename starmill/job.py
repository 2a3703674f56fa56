"""Full refresh from a wide CSV: extract, transform, load, validate, export.

    python -m starmill.job --source FILE_OR_DIR --warehouse DIR [--append] [--max-rejects N] [--export DIR] [--first PERIOD] [--last PERIOD]
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmill.config import StarConfig
from starmill.operators import quality
from starmill.plans import queries, validate
from starmill.plans.append import append_grain
from starmill.plans.build import build_grain, build_star
from starmill.plans.load import export_csv, load_star
from starmill.plans.star import FACT, MEASURE, Star
from starmill.presets import HEADLINE_LEAF, STATE_INCIDENCE
from starmill.session import get_session
from starmill.sources.wide import FAULTS, read_wide_csv, read_wide_csv_marked, write_rejects

REPORTS, REJECTS = "_reports", "_rejects"
#: Labels before and after every period.
FIRST_PERIOD, LAST_PERIOD = "0000-00", "9999-99"


def refresh(spark: SparkSession, source: str, warehouse: str, config: StarConfig, max_rejects: int | None = None) -> Star:
    """Rebuild the star from `source` and publish it under `warehouse` if the written tables
    pass every check; otherwise raise and leave the published star as it was."""
    return refresh_reported(spark, source, warehouse, config, max_rejects)[0]


def refresh_reported(
    spark: SparkSession, source: str, warehouse: str, config: StarConfig, max_rejects: int | None = None
) -> tuple[Star, DataFrame]:
    """`refresh`, and its report: rows per stage, every check with what it compared, and totals.

    The source is scanned once: what is counted and summed of it is observed in the pass that
    writes the grain. The fact's expected rows follow from the written grain, so nothing is built
    twice. The report is written under `warehouse` too, whether the load is published or refused.

    A malformed row or cell ends the refresh. With `max_rejects` such rows are written under
    `warehouse` instead, with what is wrong with them, and the load is refused only if they are more.
    """
    return _load(spark, source, warehouse, config, max_rejects, _replace)


def append_reported(
    spark: SparkSession, source: str, warehouse: str, config: StarConfig, max_rejects: int | None = None
) -> tuple[Star, DataFrame]:
    """Add the later years in `source` to the published star, see `append_years`; checks and report as in a refresh."""
    return _load(spark, source, warehouse, config, max_rejects, append_grain)


#: Sees the rows as built, the same as read back, and the whole star they are part of.
Check = Callable[[Star, Star, Star], object]


def _replace(grain: DataFrame, warehouse: str, config: StarConfig, check: Check) -> Star:
    built = build_star(grain, config)
    return load_star(built, warehouse, lambda loaded: check(built, loaded, loaded))


def _load(
    spark: SparkSession,
    source: str,
    warehouse: str,
    config: StarConfig,
    max_rejects: int | None,
    store: Callable[[DataFrame, str, StarConfig, Check], Star],
) -> tuple[Star, DataFrame]:
    run = uuid.uuid4().hex
    path = f"{warehouse}/{REPORTS}/{run}"
    if max_rejects is None:
        wide, sound, rejected = read_wide_csv(spark, source, config), F.lit(True), 0
    else:
        wide, sound = read_wide_csv_marked(spark, source, config), F.size(FAULTS) == 0
        rejected = write_rejects(wide, f"{warehouse}/{REJECTS}/{run}")
        if rejected > max_rejects:
            raise quality.QualityError(f"{rejected} rows of {source} are rejected, {max_rejects} may be; see {warehouse}/{REJECTS}/{run}")
    seen = Observation("source")
    listed = sound & F.col(f"`{config.leaf}`").isin(*config.categories)
    total = F.coalesce(F.sum(F.when(listed, quality.row_total(config.months))), F.lit(0))
    observed = wide.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(~sound).alias("rejected"),
        F.count_if(listed).alias("listed"),
        total.alias("total"),
    ).where(sound)
    grain = build_grain(observed, config)
    groups, found = grain.count(), seen.get

    def check(built: Star, new: Star, whole: Star) -> None:
        expected = {name: table.count() for name, table in built.tables().items() if name != FACT}
        expected[FACT] = groups * len(config.months)
        stages = {"source read": found["read"], "source listed": found["listed"], "grain groups": groups, "fact": expected[FACT]}
        counted = [(f"rows: {name}", n, n, quality.OK) for name, n in stages.items()]
        status = quality.OK if found["rejected"] == rejected else quality.MISMATCH
        counted.append(("rows: source rejected", rejected, found["rejected"], status))
        shape = "check string, expected bigint, loaded bigint, status string"
        counted_only = [validate.constraints(whole), validate.coverage(new, config)]
        parts = [
            spark.createDataFrame(counted, shape),
            quality.counts_against(expected, new.tables()),
            quality.total_against(MEASURE, int(found["total"]), new.fact_victimas, MEASURE),
            quality.union(counted_only).select(
                "check", F.lit(0).cast("bigint").alias("expected"), F.col("violations").alias("loaded"), "status"
            ),
        ]
        quality.union(parts).coalesce(1).write.parquet(path)
        quality.fail_on_violation(spark.read.schema(shape).parquet(path))

    star = store(grain, warehouse, config, check)
    return star, spark.read.parquet(path)


def reports(star: Star, leaf: str, first: str | None = None, last: str | None = None) -> dict[str, DataFrame]:
    """The results that feed the dashboard pages and the map, within the periods `first`..`last` if given."""
    if first or last:
        star = star.sliced(first or FIRST_PERIOD, last or LAST_PERIOD)
    return {
        "monthly_series": queries.monthly_series(star, leaf),
        "top_n_total": queries.top_n_total(star),
        "map_totals": queries.map_totals(star),
        "yoy_change": queries.yoy_change(star),
        "yearly_by_category": queries.yearly_by_category(star),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--source", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--export")
    parser.add_argument("--leaf", default=HEADLINE_LEAF)
    parser.add_argument("--first", help="first period of the exported results, such as 2018-01")
    parser.add_argument("--last", help="last period")
    parser.add_argument("--append", action="store_true", help="add the source's years to the published star")
    parser.add_argument("--max-rejects", type=int, help="set aside up to so many malformed rows")
    args = parser.parse_args()
    load = append_reported if args.append else refresh_reported
    star, report = load(get_session(), args.source, args.warehouse, STATE_INCIDENCE, args.max_rejects)
    for row in report.collect():
        print(f"{row['status']:8} {row['check']}: expected {row['expected']}, found {row['loaded']}")
    if args.export:
        for name, result in reports(star, args.leaf, args.first, args.last).items():
            export_csv(result, f"{args.export}/{name}")


if __name__ == "__main__":
    main()
