"""Physical-plan summary of every registered query (writes a markdown table).

Usage: python -m tests.plan_report [sf_dir] > PLANS.md
Counts come from the final query's physical plan (planning-time helper jobs
such as the as_of literal or a size check are separate and not counted).
"""

from __future__ import annotations

import re
import sys

KINDS = [
    ("scans", r"FileScan parquet|Scan parquet"),
    ("shuffles", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning|Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("hash_agg", r"\bHashAggregate\("),
    ("obj_hash_agg", r"ObjectHashAggregate\("),
    ("sort_agg", r"SortAggregate\("),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("window", r"\bWindow \["),
    ("python", r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython"),
    ("topk", r"TakeOrderedAndProject"),
]


def summarize(plan: str) -> dict:
    return {k: len(re.findall(p, plan)) for k, p in KINDS}


def main():
    sys.path.insert(0, ".")
    from streetlake.plans.catalog import oracle_sql, queries
    from streetlake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")    # show the static plan
    print("| query | oracle | " + " | ".join(k for k, _ in KINDS) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in KINDS) + " |")
    o = oracle_sql()
    for name, fn in queries().items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {'O' if name in o else 'R'} | " + " | ".join(str(s[k]) for k, _ in KINDS) + " |")


if __name__ == "__main__":
    main()
