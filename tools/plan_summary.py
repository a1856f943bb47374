"""Physical-plan summary of registered queries (after AQE is planned, before it re-plans).

usage: python tools/plan_summary.py [sf_dir] name ...
Prints a markdown table: exchanges, Parquet scans, sort-merge / broadcast joins, windows.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seqwise.queries import all_queries  # noqa: E402
from seqwise.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark(shuffle_partitions=8)
    qs = all_queries()
    print("| query | exchanges | scans | sort-merge joins | broadcast joins | windows | group limit |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for n in names:
        df = qs[n](spark, sf)
        df.write.format("noop").mode("overwrite").save()      # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"(?<![A-Za-z])Exchange\b", plan))
        print(f"| {n} | {shuffles} | {plan.count('Scan parquet')} | {plan.count('SortMergeJoin')} | "
              f"{plan.count('BroadcastHashJoin')} | {len(re.findall(r'(?<![A-Za-z])Window ', plan))} | "
              f"{'yes' if 'WindowGroupLimit' in plan else 'no'} |")


if __name__ == "__main__":
    main()
