"""Daily aggregates. Every aggregate has a map-side part, so a hot restaurant or day
reaches the shuffle as one partial row per task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.schemas import SILVER_COLUMNS

DEFAULT_RATING = 4.0


def _daily_mean_rating(ratings: DataFrame, who: str, mark: str) -> DataFrame:
    return (ratings.groupBy(F.to_date("rating_time").alias("report_date"), who)
            .agg(X.mean_rating(F.col(mark)).alias("avg_rating")))


def _with_rating(performance: DataFrame, ratings: DataFrame, who: str, mark: str,
                 default_rating: float) -> DataFrame:
    # both sides are already hashed on (report_date, who): the join adds no shuffle
    return (performance
            .join(_daily_mean_rating(ratings, who, mark), ["report_date", who], "left")
            .withColumn("avg_rating", F.coalesce("avg_rating", F.lit(default_rating))))


def restaurant_performance(orders: DataFrame, ratings: DataFrame, as_of,
                           default_rating: float = DEFAULT_RATING) -> DataFrame:
    """Silver orders and ratings per day and restaurant. Revenue includes cancelled orders."""
    cancelled = F.count_if(F.col("cancelled"))
    performance = orders.groupBy(F.to_date("order_time").alias("report_date"), "restaurant_id").agg(
        X.mean_minutes(F.col("prep_time_minutes")).alias("avg_prep_time"),
        F.count("order_id").alias("orders_count"),
        X.share(cancelled, F.count("order_id"), 3).alias("cancel_rate"),
        X.mean_money(F.col("tip_amount")).alias("avg_tip"),
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
    )
    rated = _with_rating(performance, ratings, "restaurant_id", "food_rating", default_rating)
    return (rated.withColumn("ingest_timestamp", S.instant(as_of))
            .select(*SILVER_COLUMNS["restaurant_performance"]))


def driver_performance(orders: DataFrame, ratings: DataFrame, as_of,
                       default_rating: float = DEFAULT_RATING) -> DataFrame:
    """Silver orders and ratings per day and driver; every status counts as an order."""
    driven = orders.filter(F.col("driver_id").isNotNull())
    performance = driven.groupBy(F.to_date("order_time").alias("report_date"), "driver_id").agg(
        F.count("order_id").alias("orders_completed"),
        X.mean_minutes(F.col("delivery_time_minutes")).alias("avg_delivery_time"),
        X.sum_money(F.col("tip_amount")).alias("total_tips"),
    )
    rated = _with_rating(performance, ratings, "driver_id", "driver_rating", default_rating)
    return (rated.withColumn("ingest_timestamp", S.instant(as_of))
            .select(*SILVER_COLUMNS["driver_performance"]))


def _plain_mean_minutes(col):
    return F.sum(X.whole_seconds(col)) / (F.lit(60.0) * F.count(col))


def daily_performance(scored: DataFrame, as_of, lookback: str | None = "1 DAY") -> DataFrame:
    """Scored orders per day, restaurant and driver, for records processed within `lookback`.

    The exact distinct count shuffles on (group, customer) first, so no single
    task sees all customers of a hot group.
    """
    recent = scored if lookback is None else scored.filter(
        S.within(F.col("processing_timestamp"), as_of, lookback))
    grouped = recent.groupBy(
        F.to_date("order_time").alias("performance_date"), "restaurant_id", "driver_id",
    ).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
        _plain_mean_minutes(F.col("delivery_time_minutes")).alias("avg_delivery_time"),
        _plain_mean_minutes(F.col("prep_time_minutes")).alias("avg_prep_time"),
        F.count_if(F.col("cancelled")).alias("cancelled_orders"),
        (F.sum(X.tenths(F.col("data_quality_score")))
         / (F.lit(10.0) * F.count("data_quality_score"))).alias("avg_quality_score"),
    )
    return (grouped.withColumn("processing_timestamp", S.instant(as_of))
            .select(*SILVER_COLUMNS["daily_performance"]))
