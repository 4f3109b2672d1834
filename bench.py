"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Per query: one cold run, then the median of the warm ones. Every row is computed
and thrown away (the noop sink), so no result passes through the driver.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from courierlake.plans.queries import QUERIES  # noqa: E402
from courierlake.session import build_session  # noqa: E402
from courierlake.sources.synth import synth_orders  # noqa: E402

HEADLINE = [
    "silver_orders", "silver_order_items", "silver_ratings", "restaurant_performance", "driver_performance",
    "daily_performance", "fact_orders", "fact_order_items", "fact_ratings", "fact_restaurant_daily",
    "business_summary", "scd2_restaurants", "scd2_as_of", "dedup_latest", "upsert_status", "lateness_summary",
    "late_impact", "order_detail", "customer_value", "core_metrics", "delivery_stats", "top_restaurants",
    "top_restaurants_rated", "top_drivers", "status_share", "dq_ratings",
]
SYNTH_ORDERS = 5_000


def timed(run) -> float:
    began = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    for name in only:
        cold[name] = round(timed(lambda: QUERIES[name](spark, folder)), 3)
        warm[name] = round(statistics.median(timed(lambda: QUERIES[name](spark, folder))
                                             for _ in range(warm_runs)), 3)

    def synth():
        made = synth_orders(spark, SYNTH_ORDERS, 1, "2024-03-01")
        for df in (made.order_items, made.ratings):
            df.write.format("noop").mode("overwrite").save()
        return made.orders

    timed(synth)
    line = {
        "metric": "total warm seconds of the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "synth_5000_orders_sec": round(timed(synth), 3),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
