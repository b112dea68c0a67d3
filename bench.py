"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salescast.session import checkpoint_dir, get_session, input_bytes, sizing  # noqa: E402
from salescast.plans import catalog  # noqa: E402
from salescast.plans.context import Context  # noqa: E402
from salescast.sources import io  # noqa: E402

HEADLINE = [
    "sb2_features", "sb6_fact_sales", "ag4_revenue_by_category_year", "ag1_kpis",
    "me4_yoy_month", "me5_revenue_ytd", "me7_mape_by_category", "me9_pct_of_category_by_family",
    "me14_forecast_variance_by_category", "rl1_role_kpis", "fc6_fact_forecasts", "fc7_weekly_rollup",
    "wn15_target_rolling", "ml9_baseline_leaderboard", "ml15_backtest_naive", "ml4_gbt_holdout",
    "ml5_second_booster_holdout", "ml6_random_forest_holdout", "ml7_elastic_net_holdout",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    size = input_bytes([os.path.join(sf_dir, f) for f in os.listdir(sf_dir)])
    scratch = tempfile.mkdtemp(prefix="salescast-bench-")
    events = os.path.join(scratch, "events")
    os.makedirs(events)
    spark = get_session(f"local[{cpus}]", "salescast-bench",
                        {**sizing(size, int(cpus)), "spark.driver.memory": "16g",
                         "spark.eventLog.enabled": "true", "spark.eventLog.dir": events})
    checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    qs = catalog.queries()
    times: dict[str, float] = {}

    # end-to-end preparation: raw tables -> features -> star -> Parquet
    t0 = time.time()
    ctx = Context.shared(spark, sf_dir)
    io.write_star(ctx.forecast_star, os.path.join(scratch, "star"), features=ctx.features)
    times["prepare_write_star"] = round(time.time() - t0, 3)

    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()
    # stage timings: python tools/stage_report.py <events dir>
    print(f"event log: {events}", file=sys.stderr)


if __name__ == "__main__":
    main()
