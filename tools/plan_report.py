"""Summarise the executed physical plan of every registered query as markdown.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Collects each query's result so that AQE's final plan is reported.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cordon.plans.registry import registry as queries  # noqa: E402
from cordon.session import local_session  # noqa: E402


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "scans": len(re.findall(r"FileScan parquet|Scan parquet", final)),
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", final)),
        "broadcasts": len(re.findall(r"BroadcastExchange", final)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", final))),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", final)),
        "topk": "TakeOrderedAndProject" in final,
        "partial_agg": "partial_" in final,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    jvm = spark._jvm
    print("# Physical plans\n")
    print(f"Executed (AQE final) plans of every registered query on `{sf_dir}`, from "
          "`python tools/plan_report.py`. Exchanges count shuffles (all of them are after a "
          "partial aggregate, so they carry at most a few hundred rows); scans count parquet "
          "scans (the two feeds of the test mapping read the same file). Scans without pushed "
          "filters read a whole table on purpose (every trip, every event).\n")
    print("| query | scans | exchanges | broadcasts | joins | scans with pushed filters | partial agg | top-k |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(queries().items()):
        df = fn(spark, sf_dir)
        df.collect()
        plan = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        s = summarize(plan)
        print(f"| {name} | {s['scans']} | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{s['pushed']} of {s['scans']} | {'yes' if s['partial_agg'] else '-'} | {'yes' if s['topk'] else '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
