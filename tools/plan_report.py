"""Write PLANS.md: physical-plan facts for the headline queries.

usage: python tools/plan_report.py [sf_dir]

For each query: exchanges, join strategies, partial (map-side) vs final
aggregates, Python nodes, and the columns each parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["page_to_answer", "html_tables", "combine_text", "facts_by_priority", "first_meaningful",
            "profile_record", "extract_urls", "route_contacts", "region_pick", "overview_blocks_answers",
            "attach_answers", "build_prompt", "profile_wide", "stream_vendor_pipeline"]


def facts(plan: str) -> dict:
    return {
        "exchanges": plan.count("Exchange "),
        "joins": sorted({j for j in re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                                  r"BroadcastNestedLoopJoin|CartesianProduct)", plan)}),
        "partial_aggs": len(re.findall(r"functions=\[partial_", plan)) + plan.count("partial_"),
        "python": sorted(set(re.findall(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas\w*)",
                                        plan))),
        "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from vendorscope.plans.catalog import all_queries
    from vendorscope.session import build_session
    spark = build_session("local[4]", 8)
    qs = all_queries()
    out = ["# PLANS", "",
           f"Physical plans (before adaptive re-planning) of the headline queries on `{sf}`,",
           "written by `tools/plan_report.py`. Exchanges are shuffles; partial aggregates",
           "combine rows on the map side before a shuffle; scans list the columns read.", ""]
    for name in HEADLINE:
        df = qs[name].build(spark, sf)
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        f = facts(formatted)
        out += [f"## {name}", "", f"- {qs[name].doc}",
                f"- exchanges: {f['exchanges']}; joins: {', '.join(f['joins']) or 'none'}; "
                f"partial aggregates: {'yes' if f['partial_aggs'] else 'none'}; "
                f"python: {', '.join(f['python']) or 'none'}",
                "- scans:"] + [f"  - `{s}`" for s in f["scans"]] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
