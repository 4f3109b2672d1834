"""Lag, unreadable rows and state of streams, batch by batch."""

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_streaming import ingest_orders, messages, put

from courierlake.schemas import BRONZE
from courierlake.sources import synth
from courierlake.sources.lake import Lake
from courierlake.streaming import watch


def test_lag_of_each_batch_is_stored(spark, tmp_path):
    made = synth.synth_orders(spark, 20, 3, "2024-03-01 00:00:00", days=3).orders.select(*BRONZE["orders"].names)
    at = lambda **ago: made.withColumn("order_time", F.lit(str(datetime.now() - timedelta(**ago))).cast("timestamp"))
    lake, folder, stored = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "in"), str(tmp_path / "progress")
    listener = watch.StreamWatch()
    spark.streams.addListener(listener)
    try:
        for name, df, extra in (("a", at(minutes=1), []), ("b", at(hours=5), ["{broken"] * 5), ("c", at(days=9), [])):
            put(folder, name, messages(df) + extra)
            ingest_orders(lake, folder, str(tmp_path / "ckpt"))
        end = time.monotonic() + 20
        written = 0
        while written < 3 and time.monotonic() < end:
            written += listener.store(spark, stored)
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.store(spark, stored) == 0
    progress = spark.read.parquet(stored)
    twice = progress.unionAll(progress.filter("batch_id = 1"))
    got = {r.batch_id: r for r in watch.stream_health(twice).filter("rows > 0").collect()}
    assert [got[i].level for i in range(3)] == ["OK", "Warning", "Critical"]
    assert [got[i].unreadable_share for i in range(3)] == [0, 0.2, 0]
    assert [got[i].late_rows for i in range(3)] == [0, 20, 20] and got[2].query == "bronze_orders"
    assert abs(got[1].max_lag_seconds - 5 * 3600) < 120
    assert watch.stream_health(progress).count() == progress.count()
