"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
`star_build` builds and loads a star from the order tables, without a CSV or checks; `job_refresh`
is the whole job from a CSV of the wide source: scan, build, load, all checks, report. Star queries
run on the loaded star, the others on the tables. Every query runs once unmeasured, then RUNS times
in full into a sink that discards rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starmill import job
from starmill.session import get_session, scratch_path
from starmill.sources.wide import write_wide_csv
from workload import wide
from workload.registry import REGISTRY

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = 3


def timed(run) -> float:
    """Median seconds of RUNS runs."""
    taken = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def refresh(spark, source: str) -> None:
    job.refresh(spark, source, scratch_path(spark, "warehouse"), wide.config(spark, SF_DIR))


def main() -> None:
    spark = get_session(
        "bench",
        {
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wide.built(spark, SF_DIR)
    source = scratch_path(spark, "source")
    write_wide_csv(wide.wide_source(spark, SF_DIR), source, wide.config(spark, SF_DIR))
    refresh(spark, source)
    seconds = {
        "star_build": timed(lambda: wide.build(spark, SF_DIR)),
        "job_refresh": timed(lambda: refresh(spark, source)),
    }
    chosen = sys.argv[1:] or list(REGISTRY)
    for name in chosen:
        def run(query=REGISTRY[name]) -> None:
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = timed(run)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "state": f"warm, median of {RUNS}",
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
