"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing comes back to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kitwise.plans.catalog import query  # noqa: E402
from kitwise.plans.report_job import run_report  # noqa: E402
from kitwise.plans.session import local_session  # noqa: E402
from kitwise.sources import standins  # noqa: E402

HEADLINE = (
    "scoped_bom_plain_path",
    "part_rollup_max",
    "ancestor_usage",
    "line_gross_demand",
    "weekly_remaining_demand",
    "part_net_demand",
    "move_category",
    "inventory_alt",
    "in_transit_alt",
    "buildable_sets",
    "line_parent_stock",
    "weeks_of_stock",
    "supply_plan_alt",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    times: dict[str, float] = {}
    # Derive the stand-in inputs from the test tables once (as Parquet input
    # tables); every query below reads them. Counted in the total.
    t = time.perf_counter()
    standins.load(spark, sf_dir).write_all()
    times["inputs"] = round(time.perf_counter() - t, 3)
    for name in HEADLINE:
        t = time.perf_counter()
        _run(query(name)(spark, sf_dir))
        times[name] = round(time.perf_counter() - t, 3)
    # The whole report as a job: shared stages written once, 76 published columns.
    t = time.perf_counter()
    run_report(standins.load(spark, sf_dir), standins.PARAMS, sink=_run)
    times["report_final"] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
