"""Summarise the executed physical plan of registered queries.

    python tools/plan_summary.py [sf_dir] [name ...] > PLANS.md

For each query: shuffles (exchange kind and keys), aggregate operators,
joins, each scan's read schema and pushed filters, and how many operators
run inside whole-stage codegen.  Plans are taken after execution, so AQE's
final choices (coalesced partitions, broadcasts) are shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ("j1_silver_olx", "j1_silver_otodom", "j2_analytics", "j3_ml_dataset", "d3_documents",
           "x13_bronze_olx", "x4_links", "s11_crawl_seeds", "a4_mode", "a6_rmse")


def summarise(name: str, plan: str) -> list[str]:
    out = [f"## {name}", ""]
    exchanges = re.findall(r"Exchange (\w+Partitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", plan)
    exchanges += re.findall(r"(hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|SinglePartition)", plan)
    seen = []
    for e in exchanges:
        if e not in seen:
            seen.append(e)
    aggs = sorted(set(re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b", plan)))
    joins = sorted(set(re.findall(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b", plan)))
    out.append(f"- shuffles: {len(seen)}" + ("" if not seen else " — " + "; ".join(f"`{s[:90]}`" for s in seen)))
    out.append(f"- aggregates: {', '.join(aggs) or 'none'}; joins: {', '.join(joins) or 'none'}")
    for rs in sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", plan))):
        out.append(f"- scan reads `{rs[:160]}`")
    for pf in sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", plan))):
        if pf != "[]":
            out.append(f"- pushed filters `{pf[:160]}`")
    stars = len(re.findall(r"^\s*[:+\- ]*\*\(\d+\)", plan, flags=re.M))
    out.append(f"- operators inside whole-stage codegen: {stars}")
    out.append("")
    return out


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or list(DEFAULT)
    from offerlake.catalog import REGISTRY
    from offerlake.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false", "spark.sql.debug.maxToStringFields": "10000", "spark.sql.maxMetadataStringLength": "10000"})
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plan_summary.py` at `{sf}` (after execution, AQE final plans).", "",
             "How to read them:", "",
             "- `RoundRobinPartitioning(n)` right above a scan is `fixtures.spread`: the test tables are one",
             "  Parquet row group each, read by one task; a table of many files skips it.",
             "- Each dedup key costs one `hashpartitioning` with a partial `SortAggregate` before it (map-side",
             "  reduction of hot keys) and the final one after it; J1 has two keys, so two hash shuffles per site.",
             "- The gold sort is a `rangepartitioning` on (offer_date, row hash): a hot date still splits.",
             "- Scans read only the columns the query needs (`scan reads`); the fixtures' filters are",
             "  expressions over computed columns and so are evaluated after the scan, not pushed.", ""]
    for name in names:
        df = REGISTRY[name](spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this plan itself, so the adaptive plan is final
        plan = qe.executedPlan().toString()
        lines += summarise(name, plan)
    print("\n".join(lines))


if __name__ == "__main__":
    main()
