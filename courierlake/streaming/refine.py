"""Streams beyond bronze: duplicates, day windows under a watermark, silver and gold per batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.operators import clean, daily, dims, facts
from courierlake.operators.merge import dedup_latest
from courierlake.sources.lake import BATCH, Lake

WATERMARK = "48 hours"


def dedup_stream(orders: DataFrame, ts: str = "order_time", watermark: str = WATERMARK) -> DataFrame:
    """Each order once, whatever the source delivers again within the watermark."""
    return orders.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["order_id"])


def daily_windows(orders: DataFrame, ts: str = "order_time") -> DataFrame:
    """Day windows of orders with amounts and delivery times; the same on a batch and on a stream."""
    return orders.groupBy(F.window(ts, "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
        F.count_if(F.col("cancelled")).alias("cancelled_orders"),
        X.mean_minutes(F.col("delivery_time_minutes")).alias("avg_delivery_time"),
        F.approx_count_distinct("customer_id").alias("customers_estimate"),
    ).select(F.col("day.start").alias("window_start"), F.col("day.end").alias("window_end"),
             "total_orders", "total_revenue", "cancelled_orders", "avg_delivery_time", "customers_estimate")


def daily_stream_performance(orders: DataFrame, ts: str = "order_time",
                             watermark: str = WATERMARK) -> DataFrame:
    """Day windows that accept rows up to `watermark` late and are final once emitted (append mode)."""
    return daily_windows(orders.withWatermark(ts, watermark), ts)


def latest_orders(scored: DataFrame) -> DataFrame:
    """The newest state of each scored order: retries and status changes append, readers take the last."""
    return dedup_latest(scored, ["order_id"], ["arrival_time", BATCH, "status", "delivery_time", "total_amount"])


def refresh_from_stream(lake: Lake, batch: DataFrame, batch_id: int) -> None:
    """Silver and gold for one batch of readable bronze orders with their `arrival_time`.

    Only the batch itself and the days it touches are read; every write is keyed
    by batch or by day, so running a batch again changes nothing. The batch's
    newest arrival is its "now".
    """
    as_of = batch.agg(F.max("arrival_time").cast("string")).first()[0]
    if as_of is None:
        return
    lake.append_batch(clean.score_orders(batch, as_of), "silver", "silver_scored_orders", batch_id)

    days = dims.distinct_days(batch.select(F.to_date("order_time")))
    scored = lake.read("silver", "silver_scored_orders")
    # orders without a day are a group of their own
    of_days = latest_orders(scored.filter(F.col("order_date").isin(days) | F.col("order_date").isNull()))
    lake.replace_days(daily.daily_performance(of_days, as_of, lookback=None), "silver", "silver_daily_performance")

    own = scored.filter(F.col(BATCH) == batch_id)
    drivers, restaurants = (lake.read_or_none("gold", t) for t in ("dim_drivers", "dim_restaurants"))
    fresh = facts.recent_fact_orders(latest_orders(own), drivers, restaurants, as_of)
    held = lake.read_or_none("gold", "fact_orders_stream")
    if held is not None:
        # an order that comes again replaces its row, whatever day it stood on; `streaming.state` keeps that day in
        # state, here two columns of the table are searched for it
        moved = held.select("order_id", "order_day").join(fresh.select("order_id"), "order_id", "left_semi")
        days = sorted({*days, *dims.distinct_days(moved.select("order_day"))})
        of_days = held.filter(F.col("order_day").isin(days) | F.col("order_day").isNull()).select(*fresh.columns)
        fresh = of_days.join(fresh.select("order_id"), "order_id", "left_anti").unionByName(fresh)
    lake.replace_days(fresh, "gold", "fact_orders_stream", days)

    # orders of the last day, for customers seen in this batch only
    recent = scored.filter(F.col("order_date") >= F.date_sub(F.lit(as_of).cast("date"), 1))
    theirs = latest_orders(recent).join(own.select("customer_id").distinct(), "customer_id", "left_semi")
    lake.append_batch(facts.customer_activity(theirs, as_of), "gold", "customer_activity", batch_id)


def latest_activity(activity: DataFrame) -> DataFrame:
    """One row per customer from the appended updates."""
    return dedup_latest(activity, ["customer_id"], ["updated_timestamp", BATCH])
