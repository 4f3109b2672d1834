"""What the plans do with hot keys, and what they may broadcast."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from courierlake import session
from courierlake.operators import dims, facts
from courierlake.plans.queries import QUERIES
from courierlake.sources import synth

AS_OF = "2024-03-01 00:00:00"

# Nothing fits a broadcast and a few kilobytes are a hot partition.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
SMALL_PIECES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB"}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["driver_001", None])
def test_hot_and_null_keys_are_split(spark, tmp_path, hot):
    """Half of all orders share a driver, or have none."""
    made = synth.synth_orders(spark, 20_000, 11, AS_OF, partitions=8)
    driver = F.when(F.xxhash64("order_id") % 2 == 0, F.lit(hot)).otherwise(F.col("driver_id"))
    orders = made.orders.withColumn("driver_id", driver).withColumns({
        "prep_time_minutes": F.lit(1.0), "delivery_time_minutes": F.lit(2.0), "cancelled": F.lit(False),
        "ingest_timestamp": F.lit(AS_OF).cast("timestamp")})
    orders.repartition(16).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    snapshot = synth.synth_drivers(spark, 200).withColumn("ingest_timestamp", F.lit(AS_OF).cast("timestamp"))
    drivers = dims.first_load(snapshot, dims.DRIVERS, AS_OF)
    keys = ["order_id", "driver_key"]
    want = facts.fact_orders(orders, drivers, None, None).select(*keys).collect()
    with conf(spark, {**LARGE, **SMALL_PIECES}):
        df = facts.fact_orders(orders, drivers, None, None).select(*keys)
        plan = final_plan(df)
        got = df.collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 20_000
    assert "skewed" in plan and "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("name", ["fact_orders", "fact_restaurant_daily", "scd2_as_of", "top_drivers", "upsert_status"])
def test_same_result_without_broadcasts(spark, small, name):
    want = sorted(map(str, QUERIES[name](spark, small).collect()))
    with conf(spark, LARGE):
        got = sorted(map(str, QUERIES[name](spark, small).collect()))
    assert got == want


@pytest.mark.parametrize("name", ["restaurant_performance", "business_summary", "core_metrics", "dedup_latest"])
def test_same_result_for_any_shuffle_width(spark, small, name):
    seen = set()
    for n in ("1", "8", "29"):
        with conf(spark, {"spark.sql.shuffle.partitions": n}):
            seen.add(str(sorted(map(str, QUERIES[name](spark, small).collect()))))
    assert len(seen) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_no_forced_broadcasts_no_python(spark, small, name):
    with conf(spark, LARGE):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "BatchEvalPython",
                 "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan


def test_hot_group_is_summed_before_the_shuffle(spark, small):
    plan = QUERIES["restaurant_performance"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2


def test_shuffle_width_follows_the_input(spark, small, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.size_shuffles(spark, small) == own
    monkeypatch.setattr(session, "BYTES_PER_REDUCER", 10_000)
    wide = session.size_shuffles(spark, small)
    assert wide > own and spark.conf.get(key) == str(wide)
    assert session.size_shuffles(spark, small, most=20) == 20
    monkeypatch.undo()
    session.size_shuffles(spark, small)


def test_days_are_pruned(spark, tmp_path):
    from courierlake.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    lake.replace(synth.synth_orders(spark, 200, 1, AS_OF).orders, "bronze", "bronze_orders")
    day = lake.read("bronze", "bronze_orders").filter(F.col("order_date").isin(["2024-02-10"]))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*order_date", plan)


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """All rows on one day: the rebalance hint cuts the day into files of the advised size."""
    import glob

    from courierlake.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    hot = synth.synth_orders(spark, 30_000, 1, AS_OF, partitions=8).orders.withColumn(
        "order_time", F.lit("2024-02-10 10:00:00").cast("timestamp"))
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}):
        assert lake.replace(hot, "bronze", "bronze_orders") == 30_000
    assert len(glob.glob(f"{tmp_path}/bronze/bronze_orders/v=1/order_date=*/*/*.parquet")) > 1


@pytest.mark.parametrize("name, column", [("fact_order_items", "order_key"), ("silver_order_items", "order_item_id")])
def test_texts_are_made_behind_the_joins(spark, small, name, column):
    """Digests and ids as text would be most of a line in every shuffle of a join."""
    lines = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [n for n, line in enumerate(lines) if f"AS {column}#" in line]
    joined = [n for n, line in enumerate(lines) if "Join" in line]
    assert made and joined and max(made) < min(joined)
