"""Write PLANS.md: the physical-plan shape of every registered query.

``python plan_report.py [sf_dir]`` plans each query (those that write tables and read them back are left
out: their last plan is a scan) and counts the
operators that matter at scale: shuffles, broadcasts, join strategies, aggregates, windows,
and anything that would not survive 1000x more data (cartesian or nested-loop joins, Python
nodes, unpartitioned windows).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.catalog import QUERIES  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "round-robin spreads": r"Exchange RoundRobinPartitioning",
    "single-partition exchanges": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "broadcast hash joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "partial aggregates": r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(keys?=\[[^\]]*\], functions=\[(partial_|\])",
    "windows": r"\bWindow \[",
    "map-side group limits": r"WindowGroupLimit .* Partial",
}
# Their plan would be the scan of the table that they have written: left out.
WRITERS = {
    "bronze_scan", "bronze_to_silver", "stream_upsert", "stream_quarantine_spike", "stream_dedup", "quarantine_sink", "run_day_gold",
    "run_metrics", "retry_cycle", "table_layout", "lean_stored", "merge_indexed", "mart_from_changes", "schema_history_scan", "kpi_refresh",
}
RED_FLAGS = {
    "cartesian product": r"CartesianProduct",
    "nested-loop join": r"BroadcastNestedLoopJoin",
    "python evaluation": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
    "window without partition": r"windowspecdefinition\((?!.*,.*specifiedwindowframe)",
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("plans", "local[8]", {"spark.sql.shuffle.partitions": "16", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    lines = [
        "# PLANS",
        "",
        "Generated by `python plan_report.py` from the physical plans (adaptive execution's initial",
        f"plan) of every registered query at `{sf_dir}`. Round-robin spreads come from the test tables",
        "being single-row-group files (`spread()` is a no-op on tables with enough splits). Single-",
        "partition exchanges only appear for one-row global aggregates after a partial aggregate. Queries that",
        "write tables and read them back are left out: " + ", ".join(f"`{n}`" for n in sorted(WRITERS)) + ".",
        "",
        "| Query | " + " | ".join(PATTERNS) + " | scans (pushed filters) | red flags |",
        "|---|" + "---|" * (len(PATTERNS) + 2),
    ]
    for name, fn in sorted(QUERIES.items()):
        if name in WRITERS:
            continue
        text = plan_text(fn(spark, sf_dir))
        counts = [str(len(re.findall(p, text))) for p in PATTERNS.values()]
        scans = re.findall(r"FileScan (\w+) .*?PushedFilters: \[([^\]]*)\]", text)
        pushed = sum(1 for _, f in scans if f.strip())
        flags = [k for k, p in RED_FLAGS.items() if re.search(p, text)]
        lines.append(f"| `{name}` | " + " | ".join(counts) + f" | {len(scans)} ({pushed}) | {', '.join(flags) or '-'} |")
        print(name, counts, flags, file=sys.stderr)
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
