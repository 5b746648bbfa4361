"""Summarise the physical plan of registered queries as it would run on large
inputs (size-based broadcasting off, so every join that is not hinted shows
its shuffle strategy).

Usage: python -m pickbay.checks.plan_summary [sf_dir] [key ...]
"""

from __future__ import annotations

import re
import sys
from collections import Counter

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _clean(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def _top_level_args(text: str, start: int) -> tuple[list[str], int]:
    """Split the argument list that opens at text[start] == '(' on top-level commas."""
    depth, args, cur, i = 0, [], [], start
    while i < len(text):
        ch = text[i]
        if ch == "(":
            depth += 1
            if depth == 1:
                i += 1
                continue
        elif ch == ")":
            depth -= 1
            if depth == 0:
                args.append("".join(cur).strip())
                return args, i
        elif ch == "," and depth == 1:
            args.append("".join(cur).strip())
            cur = []
            i += 1
            continue
        cur.append(ch)
        i += 1
    return args, i


def _window_partitions(plan: str):
    """Partition keys of every window function ('' when unpartitioned)."""
    for line in plan.splitlines():
        if "Window [" not in line:
            continue
        pos = line.find("windowspecdefinition(")
        if pos < 0:
            continue
        args, _ = _top_level_args(line, pos + len("windowspecdefinition"))
        keys = [a for a in args if not a.startswith("specifiedwindowframe")
                and not a.endswith(("ASC NULLS FIRST", "ASC NULLS LAST", "DESC NULLS FIRST", "DESC NULLS LAST"))]
        yield _clean(", ".join(keys))


def summarise(plan: str) -> dict:
    joins = Counter()
    for m in re.finditer(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                         r"(?:\(skew=\w+\))? \[([^\]]*)\], \[[^\]]*\], (\w+)", plan):
        joins[f"{m.group(1)}[{_clean(m.group(2))}] {m.group(3)}"] += 1
    aggs = Counter(_clean(m.group(1)) for m in re.finditer(r"(?:Hash|Sort|ObjectHash)Aggregate\(keys?=\[([^\]]*)\], "
                                                            r"functions=\[[^\]]*partial", plan))
    windows = Counter(_window_partitions(plan))
    return {
        "shuffles": len(re.findall(r"Exchange (?:hash|range|RoundRobin)", plan, re.I)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": dict(joins),
        "partial_aggregates_by": dict(aggs),
        "windows_by": dict(windows),
        "python": sorted(set(re.findall(r"(MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)",
                                        plan))),
        "cartesian": "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan,
    }


def main(argv) -> int:
    sys.path.insert(0, ".")
    from pickbay.registry import queries
    from pickbay.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or ["mark_orders", "sku_split_sales", "daily_order_count", "pareto_pick", "final_result",
                        "purchase_wide", "ingest_order_lines"]
    spark = get_session("local[8]", shuffle_partitions=8, extra=NO_BROADCAST)
    for key in keys:
        df = queries()[key](spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {key}")
        for name, value in s.items():
            print(f"  {name}: {value}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
