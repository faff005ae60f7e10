"""Write the physical plan trees of the headline queries to PLANS.md.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ("dq_checks_all_days", "anomalies_all_days", "check_dup_composite_key", "clean_events",
            "anomalies_by_entity", "checks_with_incidents", "health_daily")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidewatch.plans.queries import REGISTRY
    from tidewatch.session import build_session

    spark = build_session("local[8]", 8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plan_report.py` on `{sf_dir}` after execution (final AQE plans).", ""]
    for name in HEADLINE:
        df = REGISTRY[name](spark, sf_dir)
        df.collect()  # runs this DataFrame's own plan, so the final adaptive plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # keep the final adaptive plan only
        scans = re.findall(r"FileScan parquet \S*\[([^\]]*)\].*?PushedFilters: (\[[^\]]*\])", plan)
        lines = [ln for ln in plan.splitlines() if ln.strip()]
        tree = [re.sub(r"#\d+L?", "", ln)[:160] for ln in lines]
        out += [f"## {name}", "",
                f"exchanges: {plan.count('Exchange ') - plan.count('BroadcastExchange')}, "
                f"broadcasts: {plan.count('BroadcastExchange')}, parquet scans: {plan.count('FileScan parquet')}, "
                f"whole-stage codegen stages: {len(set(re.findall(r'[*][(](\d+)[)]', plan)))}", ""]
        for cols, pushed in scans:
            out.append(f"- scan columns `[{re.sub(r'#[0-9]+L?', '', cols)}]`, pushed filters `{pushed}`")
        out += ["", "```", *tree[:60], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
