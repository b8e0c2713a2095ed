"""Command line for the batch sales job (spark-submit or ``python -m martline.plans.cli``).

Flags follow the reference's run script (--orders/--customers/--products,
--no-validate/--no-clean/--no-transform/--no-lake/--no-load,
--continue-on-error, --batch-size); lake and warehouse locations are required
paths on shared storage. Exit codes: 0 success, 1 failure, 130 interrupted.
"""

from __future__ import annotations

import argparse
import json
import sys

from martline.plans.batch_job import Checks, Cleaning, Inputs, JobConfig, Publishing, run_job
from martline.session import build_session


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Run the batch sales job on Spark")
    p.add_argument("--orders", required=True, help="orders CSV file, directory or glob")
    p.add_argument("--customers", required=True, help="customers JSON")
    p.add_argument("--products", required=True, help="products JSON (records under --products-record-path)")
    p.add_argument("--products-record-path", default="products")
    p.add_argument("--json-lines", action="store_true", help="JSON inputs are JSON Lines (splittable)")
    p.add_argument("--lake", required=True, help="lake base path (shared storage)")
    p.add_argument("--warehouse", required=True, help="warehouse root path (shared storage)")
    p.add_argument("--no-validate", action="store_true")
    p.add_argument("--no-clean", action="store_true")
    p.add_argument("--no-transform", action="store_true")
    p.add_argument("--no-lake", action="store_true")
    p.add_argument("--no-load", action="store_true")
    p.add_argument("--no-fact", action="store_true", help="load dimensions only, as the reference does")
    p.add_argument("--dim-buckets", type=int, default=None,
                   help="create dimensions bucketed by key into N files (upserts shuffle the batch only)")
    p.add_argument("--fact-partition-by-date", action="store_true", help="partition fact_sales by date_id")
    p.add_argument("--continue-on-error", action="store_true")
    p.add_argument("--batch-size", type=int, default=1000,
                   help="accepted for compatibility; Spark writes whole partitions")
    p.add_argument("--run-id", default=None, help="id of the fact load; by default a digest of the input files")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = parse_args(argv)
    spark = build_session(a.master)
    cfg = JobConfig(
        inputs=Inputs(a.orders, a.customers, a.products, a.products_record_path, json_lines=a.json_lines),
        warehouse=a.warehouse, lake=None if a.no_lake else a.lake,
        checks=None if a.no_validate else Checks(), cleaning=None if a.no_clean else Cleaning(), enrich=not a.no_transform,
        publishing=None if a.no_load else Publishing(fact=not a.no_fact, dimension_buckets=a.dim_buckets,
                                                     partition_by=["date_id"] if a.fact_partition_by_date else None),
        go_on=a.continue_on_error, run_id=a.run_id)
    try:
        res = run_job(spark, cfg)
    except KeyboardInterrupt:
        return 130
    except Exception as e:  # noqa: BLE001
        print(json.dumps({"success": False, "error": str(e)}), file=sys.stderr)
        return 1
    print(json.dumps(res.as_dict(), default=str))
    return 0 if res.ok else 1


if __name__ == "__main__":
    sys.exit(main())
