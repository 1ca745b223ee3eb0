"""Physical-plan shape of the headline queries (exchanges, window nodes, scans).

Usage: python plan_report.py [sf_dir]   -- prints a markdown table.
Counts come from the initial adaptive plan, before run-time changes such as joins turned to
broadcasts or exchanges reused.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["panel_orders", "full_features", "split_rates", "classification_metrics", "explain_zscore", "top_factors", "month_spine"]


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from panelcast.plans.catalog import queries
    from panelcast.session import get_spark

    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    print("| query | shuffle exchanges | broadcast exchanges | reused | window nodes | parquet scans | widest scan (columns) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        df = qs[name](spark, d)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"\bShuffleQueryStage|\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan))
        bcast = plan.count("BroadcastExchange")
        reused = plan.count("ReusedExchange") + plan.count("ReusedQueryStage")
        windows = len(re.findall(r"\bWindow \[", plan))
        scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
        widest = max((len(s.split(",")) for s in scans), default=0)
        print(f"| {name} | {shuffles} | {bcast} | {reused} | {windows} | {len(scans)} | {widest} |")


if __name__ == "__main__":
    main()
