"""One report run: ``python -m cratewise RUN.json`` (or through spark-submit).

``RUN.json`` names the sources, the run parameters and where the extract goes::

    {"sources": {"stock": {"path": "...", "format": "csv"}, ...},
     "config": {"default_target_year": 2026, "brand_rules": {"families": [...]}},
     "extract": {"path": "...", "format": "parquet"},
     "checks": "folder for the check tables, optional",
     "reports": "folder for the regional, wide and two-unit reports, optional",
     "day_store": "folder that keeps the day sums of the facts from run to run, optional"}
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from cratewise.config import ReportConfig
from cratewise.plans.report import build_report
from cratewise.session import configure
from cratewise.sources.catalog import SourceSpec, load_tables
from cratewise.sources.day_store import DayStore
from cratewise.sources.extract import write_extract


def run(spark: SparkSession, plan: dict) -> dict[str, str]:
    """Runs the report and returns the load status of every source."""
    specs = {name: SourceSpec(**source) for name, source in plan["sources"].items()}
    tables, status = load_tables(configure(spark), specs)
    store = DayStore(spark, plan["day_store"]) if "day_store" in plan else None
    bundle = build_report(tables, ReportConfig.from_dict(plan.get("config", {})), reuse=True, reconcile=True, store=store)
    target = plan["extract"]
    write_extract(bundle.final_extract, target["path"], target.get("format", "parquet"))
    for folder, frames in (("checks", bundle.checks), ("reports", bundle.reports)):
        if folder in plan:
            for name, df in frames().items():
                df.write.mode("overwrite").parquet(f"{plan[folder]}/{name}")
    return status


def main() -> None:
    with open(sys.argv[1], encoding="utf-8") as handle:
        plan = json.load(handle)
    spark = SparkSession.builder.appName("cratewise").getOrCreate()
    for name, status in run(spark, plan).items():
        print(f"{name}: {status}")
    spark.stop()


if __name__ == "__main__":
    main()
