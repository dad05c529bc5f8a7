"""Bench: headline queries and an end-to-end daily run on the driver tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query is executed in full into Spark's ``noop`` sink (no
collect). ``daily_run_first`` / ``daily_run_incremental`` time two ``run_daily`` calls:
the sales feed of ``lineitem`` split into two deliveries and written as CSV files
(setup, not timed), then ingested -> silver -> gold -> reports -> checks.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerloom.plans import catalog  # noqa: E402
from ledgerloom.plans.daily_run import run_daily  # noqa: E402
from ledgerloom.session import local_session, scratch_path  # noqa: E402
from ledgerloom.sources import adapters  # noqa: E402

DELIVERY_FILES = 8
HEADLINE = [
    "sales_valid",
    "sales_rejected",
    "fact_dedup",
    "fact_merge_two_batches",
    "dim_scd2_apply",
    "report_batches",
    "report_daily",
    "report_topk",
    "check_unique",
    "batch_reconciliation",
]


def run_query(spark, name, sf_dir):
    t = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def daily_runs(spark, sf_dir, layouts):
    """Seconds of the first and the second daily run, for each layout of the fact."""
    root = scratch_path(spark, "bench")
    raw = adapters.sales_raw_of(spark, sf_dir).drop("batch_date", "file_name", "load_ts")
    li = adapters.read_table(spark, sf_dir, "lineitem")
    cut = F.col("l_shipdate") < F.lit(catalog.MERGE_CUTOFF)
    day1 = adapters.raw_sales(li.where(cut)).select(*raw.columns)
    day2 = adapters.raw_sales(li.where(~cut)).select(*raw.columns)
    sup = adapters.read_table(spark, sf_dir, "supplier")
    v1 = adapters.raw_stores(sup, (1,)).select("store_group", "store_token", "store_name")
    v2 = adapters.raw_stores(sup, (2,)).select("store_group", "store_token", "store_name")
    in1 = catalog.write_deliveries(spark, {"sales_20240101": day1, "stores_20240101": v1}, f"{root}/in1",
                                   {"sales_20240101": True}, files=DELIVERY_FILES)
    in2 = catalog.write_deliveries(spark, {"sales_20240102": day2, "stores_20240102": v2}, f"{root}/in2", {},
                                   files=DELIVERY_FILES)
    snap = dt.date(2025, 1, 1)
    out = {}
    for by in layouts:
        for day, inbox in ((1, in1), (2, in2)):
            t = time.perf_counter()
            run_daily(spark, inbox, f"{root}/wh-{by}", run_ts=dt.datetime(2024, 1, day, 3), snapshot_date=snap, fact_by=by)
            out.setdefault(by, []).append(round(time.perf_counter() - t, 3))
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2)))),
                          "ledgerloom-bench")
    # warm-up (JVM, code paths), not timed
    catalog.QUERIES["reject_reason_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        times[name] = round(run_query(spark, name, sf_dir), 3)
    daily = daily_runs(spark, sf_dir, ("month", "day"))
    times["daily_run_first"], times["daily_run_incremental"] = daily["month"]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        # the default layout, not in the total: lineitem has some 270 rows a day at sf0.1
        "daily_run_by_day": daily["day"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
