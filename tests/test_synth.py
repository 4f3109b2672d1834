"""Generated orders: repeatable, whole, and shaped as declared."""

import pytest
from pyspark.sql import functions as F

from courierlake.schemas import BRONZE
from courierlake.sources import synth

AS_OF = "2024-03-01 00:00:00"
N = 4000


@pytest.fixture(scope="module")
def made(spark):
    return synth.synth_orders(spark, N, 5, AS_OF)


def test_schema_and_counts(made):
    for name, df in (("orders", made.orders), ("order_items", made.order_items), ("ratings", made.ratings)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE[name]]
    assert made.orders.count() == N == made.orders.select("order_id").distinct().count()


def test_same_rows_for_any_partitioning(spark, made):
    other = synth.synth_orders(spark, N, 5, AS_OF, partitions=3)
    for a, b in ((made.orders, other.orders), (made.order_items, other.order_items), (made.ratings, other.ratings)):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    changed = synth.synth_orders(spark, N, 6, AS_OF)
    assert not made.orders.exceptAll(changed.orders).isEmpty()


def test_shares(made):
    o = made.orders.withColumn("h", F.hour("order_time"))
    row = o.agg(F.avg((F.col("status") == "delivered").cast("int")).alias("delivered"),
                F.avg(F.col("h").isin(12, 13, 14, 18, 19, 20, 21).cast("int")).alias("peak"),
                F.min("h").alias("first"), F.max("h").alias("last"),
                F.min("order_time").cast("string").alias("oldest"), F.max("order_time").cast("string").alias("newest"),
                F.min("tip_amount").alias("low"), F.max("tip_amount").alias("high")).first()
    assert abs(row.delivered - 0.88) < 0.03
    assert abs(row.peak - (0.6 + 0.4 * 7 / 15)) < 0.03
    assert row["first"] >= 9 and row["last"] <= 23 and 1.0 <= row.low and row.high <= 12.0
    assert row.oldest >= "2024-01-31" and row.newest < AS_OF
    rated = made.ratings.count() / made.orders.filter("status = 'delivered'").count()
    assert abs(rated - 0.7) < 0.03
    lines = made.order_items.groupBy("order_id").count().agg(F.avg("count"), F.max("count")).first()
    assert abs(lines[0] - 2.03) < 0.1 and lines[1] == 5


def test_totals_and_times_agree(made):
    sums = made.order_items.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("item_price")).alias("s"))
    off = made.orders.join(sums, "order_id").filter(F.abs(F.col("s") - F.col("total_amount")) > 0.006)
    assert off.isEmpty()
    bad = made.orders.filter(
        (F.col("status") == "cancelled") & F.col("delivery_time").isNotNull()
        | (F.col("delivery_time") <= F.col("order_time")) | (F.col("prep_end_time") <= F.col("prep_start_time")))
    assert bad.isEmpty()
    late = made.ratings.join(made.orders, "order_id").filter("rating_time <= delivery_time")
    assert late.isEmpty()


def test_reference_tables(spark):
    assert synth.synth_restaurants(spark).count() == 15
    assert synth.synth_drivers(spark).select("driver_id").distinct().count() == 20
    assert synth.synth_menu_items(spark).filter("price > 0").count() == 13
    days = [r.date for r in synth.synth_weather(spark, AS_OF).orderBy("date").collect()]
    assert len(days) == 30 and days[0] == "2024-01-31" and days[-1] == "2024-02-29"


def test_long_ids_are_not_cut(spark):
    ids = spark.range(9_999_998, 10_000_002).select(synth._coded("order_", F.col("id"), 6).alias("k"))
    assert ids.distinct().count() == 4
