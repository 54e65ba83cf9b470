"""Times the headline queries and prints one JSON line.

Each query is built and run whole (plan, driver lookups and execution), once to
warm up and then ``BENCH_RUNS`` times; the median counts. Results go to the
no-op sink, so that moving rows into Python is not part of the figure. The three
``metric_table_*`` entries compare the one-shuffle assembly with the one over
stored metric rows and with a join per measure.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cratewise.plans.wide import metric_table  # noqa: E402
from cratewise.session import local_session  # noqa: E402
from workload.join_chain import metric_table_by_joins  # noqa: E402
from workload.queries import QUERIES, Run  # noqa: E402

HEADLINE = (
    "shipment_mtd_ytd",
    "depletion_py_windows",
    "target_windows_pivot",
    "regional_actual_vs_target_py",
    "kpi_wide",
    "uom_report",
    "final_extract",
    "totals_by_uom_type",
)


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"), memory="12g")
    work = {name: lambda name=name: QUERIES[name](spark, folder) for name in HEADLINE}
    work["metric_table_one_shuffle"] = lambda: metric_table(Run(spark, folder).inputs)
    work["metric_table_kept_rows"] = lambda: metric_table(Run(spark, folder).inputs, kept=True)
    seconds = {}
    for name, build in work.items():
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(runs)), 3)
    # The yardstick is slow; one warm run places it.
    seconds["metric_table_join_chain"] = round(timed(lambda: metric_table_by_joins(Run(spark, folder).inputs)), 3)
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
