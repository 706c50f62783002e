"""Time the registered queries; prints one JSON line.

Each query runs to its full result (a ``noop`` write of every row, so nothing
is skipped and nothing is pulled to the driver). ``BENCH_QUERIES=all`` times
every registered query, a comma list times the ones it names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "q01_revenue_last_fiscal_month",
    "q02_revenue_by_region_last_quarter",
    "q03_top_members_hardware",
    "q04_business_health",
    "q05_active_members_in_region",
    "q06_quarter_revenue_by_family",
    "q07_spike_attribution",
    "q08_campaign_churn",
    "q09_revenue_unknown_sku",
    "mv_basic_by_family",
    "mv_rich_by_region",
    "mv_membership_churn",
    "mv_conformed_union",
    "mv_wide_periods",
    "mv_window_current_and_prior",
    "mv_window_fytd",
    "dedup_order_lines",
    "result_diff",
    "update_scores",
    "query_history_profile",
    "cost_single_run",
    "cost_prorated",
    "metric_tco",
    "leaderboard_per_answer",
    "stream_silver_order_lines",
    "clustered_write_roundtrip",
    "gen_lines",
)


def main() -> None:
    from kpiloom import catalog
    from kpiloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    queries = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # A query's first run in a JVM pays for class loading and code generation;
    # the second one is timed.
    timings = {}
    for name in names:
        run(name)
        timings[name] = round(run(name), 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
