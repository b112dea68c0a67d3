"""Summarise the physical plans of the headline queries (docs/PLANS.md).

    python tools/plan_report.py [sf_dir] > docs/PLANS.md

For each query: operator counts (exchanges, join strategies, windows,
subqueries) and every scan with its ReadSchema / PushedFilters /
PartitionFilters, taken from ``explain("formatted")``.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salescast.operators import star as starmod  # noqa: E402
from salescast.plans import catalog  # noqa: E402
from salescast.plans.context import Context  # noqa: E402
from salescast.session import get_session  # noqa: E402
from salescast.sources import testviews  # noqa: E402

QUERIES = ["ag4_revenue_by_category_year", "ag1_kpis", "me4_yoy_month", "me5_revenue_ytd",
           "me7_mape_by_category", "me9_pct_of_category_by_family", "jn14_context_highland_2000",
           "rl1_role_kpis", "fc1_scoring_frame", "wn15_target_rolling", "ml15_backtest_naive",
           "ml7c_ets_levels"]

COUNT = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange rangepartitioning",
         "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Window", "Subquery", "Generate", "TakeOrderedAndProject"]


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(name: str, text: str) -> list[str]:
    body = text.split("\n\n", 1)[1] if "\n\n" in text else text
    out = [f"### {name}", ""]
    counts = []
    for k in COUNT:
        key = k.split(" ")[0] if k.startswith("Exchange ") else k
        if k.startswith("Exchange "):
            n = len(re.findall(r"Arguments: " + re.escape(k.split(" ", 1)[1]), body))
        else:
            n = len(re.findall(r"^\(\d+\) " + re.escape(key) + r"\b", body, re.M))
        if n:
            counts.append(f"{k}: {n}")
    out.append("- operators: " + (", ".join(counts) if counts else "none"))
    for m in re.finditer(r"^\(\d+\) (Scan \S+.*?)\n(.*?)(?=^\(\d+\)|\Z)", body, re.M | re.S):
        head, detail = m.group(1).strip(), m.group(2)
        keep = [ln.strip() for ln in detail.splitlines()
                if ln.startswith(("ReadSchema", "PushedFilters", "PartitionFilters", "DataFilters"))]
        out.append(f"- {head}: " + "; ".join(keep) if keep else f"- {head}")
    wins = re.findall(r"windowspecdefinition\(([^)]*?)(?:,\s*specifiedwindowframe|\))", body)
    if wins:
        out.append("- window specs: " + " | ".join(sorted(set(w.strip() for w in wins)))[:600])
    out.append("")
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", "salescast-plans")
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plan_report.py` at `{sf_dir}` (initial adaptive plans; AQE may",
             "still coalesce partitions or turn a sort-merge join into a broadcast at run time).", "",
             "## Raw tables -> features (reads the driver's Parquet files)", ""]
    raw = testviews.raw_tables(spark, sf_dir)
    lines += summarise("raw train view (lineitem ⨝ orders ⨝ supplier ⨝ part, aggregated)", formatted(raw.train))
    lines += summarise("raw transactions view", formatted(raw.transactions))
    ctx = Context.shared(spark, sf_dir)
    lines += summarise("features (from the materialized train view)", formatted(starmod.features(ctx.cleaned)))
    lines += ["## Registered queries (over the materialized features and facts)", ""]
    qs = catalog.queries()
    for name in QUERIES:
        lines += summarise(name, formatted(qs[name](spark, sf_dir)))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
