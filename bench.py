"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]. Warm session, ``noop`` sink (full evaluation, no
output I/O), median of $BENCH_REPEAT runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martline.plans.registry import QUERIES  # noqa: E402
from martline.session import build_session  # noqa: E402

HEADLINE = [
    "xf_sales", "fact_sales", "bi_sales_summary", "bi_top_customers", "bi_top_products",
    "bi_daily_sales", "bi_category_performance", "agg_daily_sales", "agg_generic",
    "clean_dedup_first", "clean_ffill", "clean_fill_median", "dq_report", "dq_rule_violations",
    "join_full", "load_upsert", "src_payload_path", "agg_generic_stats", "dq_fk_orphans", "load_upsert_bucketed",
    "etl_batch_run", "stream_daily_sales", "stream_customer_activity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", cpus, app_name="martline-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("bi_sales_summary")  # warm-up: JVM, codegen caches, file listing
    times = {}
    for n in names:
        times[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "repeat": repeat,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
