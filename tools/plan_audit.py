"""Tabulate the final (adaptive) physical plan of every dashboard report.

Usage: python tools/plan_audit.py [sf_dir] > PLANS.md

Runs each report over written cleaned and typed tables and rollups and counts distinct operators in the final plan only: Parquet scans
(of them those of the lines, not of a rollup),
shuffle exchanges, broadcast and sort-merge joins, window operators, reused
subqueries and any Python evaluation node.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.plans.catalog import Retail, dashboard_queries, raw_queries, raw_table  # noqa: E402
from mercato.plans.clean import clean  # noqa: E402
from mercato.plans.rollup import write_rollups  # noqa: E402
from mercato.plans.sales import load_table, sales  # noqa: E402
from mercato.operators.materialize import write_and_reread  # noqa: E402
from mercato.session import local_session, scratch_path  # noqa: E402


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-|"))


def final_plan(df) -> str:
    """The executed plan text without any "Initial Plan" block (each adaptive
    plan, including subqueries, prints its initial plan nested under a
    marker; everything indented at or below the marker belongs to it)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    out, skip_from = [], None
    for line in text.splitlines():
        if skip_from is not None:
            if line.strip() and _indent(line) >= skip_from:
                continue
            skip_from = None
        if "== Initial Plan ==" in line:
            skip_from = line.index("==")
            continue
        if "== Final Plan ==" in line:
            continue
        out.append(line)
    return "\n".join(out)


def row(name: str, plan: str) -> str:
    # a subquery's adaptive plan may be printed more than once; identical
    # operator lines (same expression ids) are the same operator
    ops = {line.strip(" :+-") for line in plan.splitlines() if line.strip(" :+-")}
    count = lambda pat: sum(1 for op in ops if re.search(pat, op))
    return (
        f"| {name} | {count(r'FileScan parquet')} | {count(r'FileScan parquet(?!.*audit-rollups)')} | {count(r'Exchange (hashpartitioning|rangepartitioning)')} "
        f"| {count(r'Exchange SinglePartition')} | {count(r'BroadcastHashJoin')} | {count(r'SortMergeJoin')} "
        f"| {count(r'Window \[')} | {count(r'ReusedSubquery')} | {count(r'Python')} |"
    )


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print("| report | parquet scans | of the lines | key shuffles | single-partition exchanges | broadcast joins "
          "| sort-merge joins | windows | reused subqueries | python nodes |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    raw = write_and_reread(spark, raw_table(spark, sf_dir), "audit-raw")
    for name, fn in raw_queries().items():
        print(row(name, final_plan(fn(raw))))
    cleaned = write_and_reread(spark, clean(raw, keep=["row_key"]), "audit-clean")
    typed_df = write_and_reread(spark, load_table(cleaned), "audit-typed")
    rollups = write_rollups(spark, sales(typed_df), scratch_path(spark, "audit-rollups"))
    r = Retail.from_typed(spark, typed_df, cleaned, rollups=rollups)
    for name, fn in dashboard_queries().items():
        print(row(name, final_plan(fn(r))))


if __name__ == "__main__":
    main(sys.argv)
