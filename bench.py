"""Benchmark: warehouse load, stream load and every analytic query.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query's result is
written to the ``noop`` sink, so the whole plan runs (including any final
sort) without collecting rows to the driver.  ``load_warehouse`` (build
the star from the raw tables and write it) and ``stream_fact`` (the
transaction stream loader, one text file per micro-batch) are timed as
their own entries; the query timings read the written warehouse.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesloom.plans.catalog import QUERIES  # noqa: E402
from salesloom.plans.star import load_warehouse  # noqa: E402
from salesloom.session import get_spark  # noqa: E402

HEADLINE = ["q1_top_products_daytype", "q1_drilldown", "q2_store_quarter_growth",
            "q3_supplier_contribution", "q4_seasonal_sales", "q5_monthly_volatility",
            "q6_product_affinity", "q6_affinity_same_visit", "q7_revenue_rollup",
            "q8_half_year_sales", "q9_outlier_days", "q10_store_quarterly_sales",
            "enriched_sales", "revenue_by_customer_segment", "stream_fact"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # event log (stage timings for tools/eventlog.py) in a fresh scratch folder;
    # tables go to spark.checkpoint.dir as configured for the session
    scratch = tempfile.mkdtemp(prefix="salesloom-bench-")
    spark = get_spark(f"local[{cpus}]", cpus, "salesloom-bench",
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch})
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    load_warehouse(spark, sf_dir, rebuild=True)
    times["load_warehouse"] = round(time.perf_counter() - t0, 3)
    names = sys.argv[1:] or HEADLINE
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
