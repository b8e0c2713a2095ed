"""Summarize the physical plan of registered queries: shuffles, broadcasts, scans.

usage: python scripts/plan_summary.py [sf_dir] [name ...]  (prints a markdown table)
"""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martline.plans.registry import QUERIES  # noqa: E402
from martline.session import build_session  # noqa: E402


def summarize(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "sort_agg": plan.count("SortAggregate"),
        "scans": plan.count("FileScan"),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "topk": plan.count("TakeOrderedAndProject"),
    }


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or sorted(QUERIES)
    spark = build_session("local[8]", 8)
    print("| query | shuffles | broadcasts | SMJ | BHJ | sort-agg | scans | python | top-k |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for n in names:
        s = summarize(QUERIES[n](spark, sf))
        print(f"| `{n}` | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['sort_agg']} | "
              f"{s['scans']} | {s['python']} | {s['topk']} |")


if __name__ == "__main__":
    main()
