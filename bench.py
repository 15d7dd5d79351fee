"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the cores. `silver` is the build of
the conformed table that the marts read; the marts are timed on the written table, as in a
scheduled run. Every result is computed in full and thrown away. Each query first runs once on the
smallest tables, if they are there, so that timings are of queries and not of a starting JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from rollcall.catalogue import samples  # noqa: E402
from rollcall.catalogue.queries import QUERIES  # noqa: E402
from rollcall.session import build_session  # noqa: E402

HEADLINE = [
    "national_trends", "state_trends", "party_summary", "state_summary", "party_by_state", "education_dist",
    "age_by_state", "leaderboards", "repeat_entities", "winners_slice", "kpi_delta", "run_meta", "ingest_profile",
    "dedupe_report", "snapshot_diff", "parse_money", "html_clean", "title_case", "page_rows", "norm_key_join",
    "fuzzy_join", "fuzzy_join_levenshtein", "name_match", "joined_funds", "state_utilisation", "reconcile",
    "measures", "measures_two_pass", "stream_merge",
]


def run(spark: SparkSession, name: str, folder: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "rollcall-bench", f"local[{cpus}]", spark_ui_enabled="false", spark_driver_memory="12g"
    )
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    smallest = Path(folder).parent / "sf0.001"
    if smallest.is_dir():
        for name in HEADLINE:
            run(spark, name, str(smallest))
    timings: dict[str, float] = {}
    start = time.perf_counter()
    samples.silver(spark, folder)
    timings["silver"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        run(spark, name, folder)
        timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
