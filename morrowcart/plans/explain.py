"""Print a registered query's physical plan and an operator summary.

    python -m morrowcart.plans.explain training_set /root/testdata/sf0.01 [--full]

The summary counts the operators that matter at scale (shuffles, broadcasts,
join kinds, sorts, windows, Expand, cartesian / nested-loop joins) in the plan
Spark chooses before it runs; ``--full`` also prints the formatted plan.
"""

from __future__ import annotations

import argparse
import re
from collections import Counter

from pyspark.sql import SparkSession

from .registry import QUERIES

WATCH = ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Sort ",
         "Window", "Expand", "Generate", "FileScan parquet", "PythonUDF", "BatchEvalPython"]


def summarize(plan: str) -> dict[str, int]:
    counts = Counter()
    for line in plan.splitlines():
        for w in WATCH:
            if re.search(r"(^|[\s:+-])" + re.escape(w), line):
                counts[w.strip()] += 1
    return dict(counts)


def main(argv=None) -> dict[str, int]:
    p = argparse.ArgumentParser(prog="morrowcart-explain")
    p.add_argument("query", choices=sorted(QUERIES))
    p.add_argument("sf_dir")
    p.add_argument("--full", action="store_true")
    args = p.parse_args(argv)
    spark = (SparkSession.builder.appName("morrowcart-explain")
             .config("spark.ui.enabled", "false").getOrCreate())
    df = QUERIES[args.query](spark, args.sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    summary = summarize(plan)
    if args.full:
        df.explain("formatted")
    for k, v in sorted(summary.items()):
        print(f"{k:28s} {v}")
    return summary


if __name__ == "__main__":
    main()
