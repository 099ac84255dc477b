"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test directory, BENCH_CPUS the local threads, BENCH_RUNS how often
each query is timed. All queries run once before any is timed, and the best time counts.
Names as arguments restrict the run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import REGISTRY  # noqa: E402
from tillmark.session import build_session  # noqa: E402

HEADLINE = [
    "sales_trend", "user_distribution", "category_sales", "channel_analysis", "user_behavior",
    "payment_methods", "hot_products", "member_consumption", "share_of_total",
    "view_sales_summary", "view_product_sales_ranking", "view_online_offline_comparison",
    "view_user_purchase_behavior", "view_campaign_performance",
    "daily_series", "feature_frame_clean", "forecast_weekly_repeat", "linear_forecast",
    "sales_prediction",
    "incremental_scan", "incremental_merge", "latest_version", "sync_all",
    "user_search_page", "name_conflicts", "apply_updates", "cascade_delete",
    "orphans", "duplicates", "null_violations", "order_total_mismatch",
    "order_totals", "line_amounts", "calendar_weights", "inventory_grid", "default_address",
    "weighted_sample",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = sys.argv[1:] or HEADLINE
    for name in names:
        timed(name)
    times = {name: round(min(timed(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(directory).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
