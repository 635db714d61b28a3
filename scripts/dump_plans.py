"""Write the physical plans of the key queries to docs/PLANS.md.

usage: python scripts/dump_plans.py [sf_dir]
For each query: the count of Exchange / Window / aggregate / join nodes, the
pushed filters and read schemas of the scans, and the plan itself.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = ["training_panel", "district_statistics", "national_statistics", "dq_cases_suite",
       "generate_alerts", "upsert_predictions", "latest_prediction", "arima_111_forecast",
       "cases_with_district", "scan_table"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from riskpanel import catalog
    from riskpanel.session import get_session
    spark = get_session("local[8]", 8)
    out = ["# Physical plans of key queries", "",
           f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}` (initial adaptive plans).", ""]
    for n in KEY:
        df = catalog.run(n, spark, sf_dir)
        p = plan_text(df)
        counts = {k: len(re.findall(k, p)) for k in
                  ["Exchange hashpartitioning", "BroadcastExchange", "Window", "HashAggregate", "SortAggregate",
                   "SortMergeJoin", "BroadcastHashJoin"]}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", p)))
        out += [f"## {n}", "", catalog.REGISTRY[n].doc, "",
                "nodes: " + ", ".join(f"{k} x{v}" for k, v in counts.items() if v), ""]
        if pushed:
            out += ["pushed filters: " + "; ".join(x for x in pushed if x), ""]
        out += ["```", p.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
