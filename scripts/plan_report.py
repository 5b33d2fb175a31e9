"""Summarise the physical plan of every registered query.

For each query: shuffles by kind, Python steps, partial window limits before a
shuffle, broadcasts, and the filters pushed into Parquet scans.  Plans are the
initial adaptive plans (AQE may still coalesce partitions or switch a join to
broadcast at run time).

Usage: python scripts/plan_report.py [SF_DIR] > PLANS.md
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkloom.plans.queries import QUERIES  # noqa: E402
from linkloom.session import build_session  # noqa: E402


def summary(plan: str) -> dict:
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan)
    kinds = {}
    for k in ex:
        kinds[k] = kinds.get(k, 0) + 1
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)) - {"[]"})
    return {
        "shuffles": ", ".join(f"{v}x {k}" for k, v in sorted(kinds.items())) or "none",
        "python": len(re.findall(r"ArrowEvalPython|MapInPandas|BatchEvalPython", plan)),
        "partial_limit": "yes" if re.search(r"WindowGroupLimit .*Partial", plan) else "",
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "pushed": "; ".join(pushed),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.driver.memory": "8g"})
    print("| query | shuffles | Python steps | partial limit before shuffle | broadcasts | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['python']} | {s['partial_limit']} | {s['broadcast']} | {s['pushed']} |")


if __name__ == "__main__":
    main()
