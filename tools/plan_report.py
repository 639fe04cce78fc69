"""Write PLANS.md: the final (AQE) physical plan shape of every query.

Usage: python tools/plan_report.py [sf_dir]
Queries of the training-data operators are left out: their work is in eager stages before the plan that they return.
Each query is executed with ``collect`` so that its own QueryExecution holds
the final adaptive plan, which is then summarised.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadloom.plans.checks import formatted_plan  # noqa: E402
from roadloom.plans.contract import registered  # noqa: E402
from roadloom.session import build_session  # noqa: E402

NOTES = {
    "booking_stats": "filtered dimension joined (broadcast by AQE when small, else sort-merge); aggregate reuses the join key",
    "event_rollup": "staged exact rollup: no Expand; reused exchanges for the shared dedup stages",
    "event_sequence": "segmented scan: bounds as a scalar subquery, window per (key, segment), carries of cut keys joined back",
    "event_gaps_days": "as event_sequence, lag instead of row_number",
    "monthly_event_profile": "segmented scan for the gap, then one aggregate; distinct locations via the distinct-aggregate rewrite",
    "warranty_status": "joined rows kept once, read for the report and for the per-status counts (<= 3 rows, broadcast); global sort as specified",
    "trips_late_merge": "states of three batches merged by min / max of structs",
    "event_rollup_delta": "stored state without the delta's months, those worked out again, coarser levels added up",
    "fleet_pipeline_rejects": "positions parsed once per row behind a generator",
    "event_first": "min of struct: partial + final aggregate, no window",
    "dedupe_latest": "max of struct: partial + final aggregate, no window",
    "trip_first_last": "min and max of structs in one aggregate",
    "nearest_site": "grid equi-join on cells (sites copied to 3x3 cells), exact filter, min-of-struct aggregate",
    "geometry_groups": "features kept once, grouped count, equi-join back on the group key",
    "key_set_changes": "one aggregate over the tagged union of both key sets",
    "null_report": "only keys and null flags are joined",
    "delta_new_rows": "watermark is a literal: pushed to the scan",
    "delta_upsert": "delta reduced to one row per key, then anti join of the snapshot",
}


def final_tree(plan: str) -> str:
    """The node tree of the final adaptive plan (the formatted text also
    carries the initial plan)."""
    tree = plan.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    return tree


def summarize(plan: str) -> dict:
    tree = final_tree(plan)
    return {
        "shuffles": sum(1 for line in tree.splitlines() if "Exchange" in line and "Broadcast" not in line
                        and "Reused" not in line and "QueryStage" not in line),
        "broadcasts": sum(1 for line in tree.splitlines() if "BroadcastExchange" in line and "QueryStage" not in line),
        "reused": sum(1 for line in tree.splitlines() if "Reused" in line),
        "joins": sorted({m for m in re.findall(r"(BroadcastHashJoin \w+|SortMergeJoin \w+|ShuffledHashJoin \w+|BroadcastNestedLoopJoin|CartesianProduct)", tree)}),
        "windows": tree.count("Window ") + tree.count("Window\n"),
        "expand": "Expand" in tree,
        "python": any(p in plan for p in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython")),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# PLANS — final physical plans at " + os.path.basename(sf), "",
           "Generated by `python tools/plan_report.py`.  Each query is executed, then its final adaptive",
           "plan is read: shuffles (non-broadcast exchanges), broadcasts, reused exchanges, join strategies,",
           "windows, Expand, Python nodes, and what every file scan reads and has pushed down.", ""]
    out.append("| query | shuffles | broadcasts | reused | joins | windows | Expand | Python | note |")
    out.append("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    scans = []
    for name, fn in registered().items():
        df = fn(spark, sf)
        df.collect()
        plan = formatted_plan(df)
        s = summarize(plan)
        out.append(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['reused']} | {', '.join(s['joins']) or '-'} | "
                   f"{s['windows']} | {'yes' if s['expand'] else 'no'} | {'yes' if s['python'] else 'no'} | {NOTES.get(name, '')} |")
        details = [ln.strip() for ln in plan.splitlines() if ln.strip().startswith(("PushedFilters", "ReadSchema"))]
        scans.append((name, details))
    out += ["", "## Scans (pushed filters and read schema per file scan)", ""]
    for name, details in scans:
        out.append(f"### {name}")
        out.append("```")
        out += details or ["(no file scan in final plan)"]
        out.append("```")
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
