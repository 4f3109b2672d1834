"""Silver to gold facts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.functions.keys import hash_key
from courierlake.operators.daily import DEFAULT_RATING
from courierlake.operators.dims import DRIVERS, RESTAURANTS, current
from courierlake.operators.joins import with_date_key, with_key, with_version_key
from courierlake.schemas import GOLD_COLUMNS

EARNINGS_PER_TIP = 1.2
HOURS_PER_ORDER = 0.75
UNKNOWN_KEY = -1
PERIODS = {"daily": "day", "hourly": "hour"}


def fact_orders(orders: DataFrame, drivers: DataFrame | None, restaurants: DataFrame | None,
                calendar: DataFrame | None, sla: float = S.SLA_MINUTES, dated: bool = False) -> DataFrame:
    """One row per silver order; an id or day no dimension holds leaves a null key.

    With `dated`, here and below, keys are those of the dimension version of the fact's day, else of the current one.
    """
    day = F.to_date("order_time") if dated else None
    keyed = with_version_key(orders, drivers, DRIVERS, day)
    keyed = with_version_key(keyed, restaurants, RESTAURANTS, day)
    keyed = with_date_key(keyed, calendar, F.to_date("order_time"))
    return keyed.withColumns({
        "order_key": hash_key("order_id"),
        "delivery_minutes": F.round("delivery_time_minutes", 1),
        "prep_time_minutes": F.round("prep_time_minutes", 1),
        "sla_breached": S.sla_breached(F.col("delivery_time_minutes"), sla),
    }).select(*GOLD_COLUMNS["fact_orders"])


def fact_order_items(items: DataFrame, orders: DataFrame, menu: DataFrame | None,
                     calendar: DataFrame | None) -> DataFrame:
    """One row per line of an order in fact_orders; lines without their order are dropped.

    The order's key is that of fact_orders, made again from the order_id: as a digest it would be the largest part of
    a line in the shuffles behind the join.
    """
    lines = items.join(orders.select("order_id"), "order_id")
    lines = with_key(lines, menu, "item_id", "menu_item_key")
    lines = with_date_key(lines, calendar, F.to_date("order_time"))
    return (lines.withColumns({"order_item_key": hash_key("order_item_id"), "order_key": hash_key("order_id")})
            .select(*GOLD_COLUMNS["fact_order_items"]))


def fact_ratings(ratings: DataFrame, orders: DataFrame | None, drivers: DataFrame | None,
                 restaurants: DataFrame | None, calendar: DataFrame | None, dated: bool = False) -> DataFrame:
    """One row per rating; the order key is null for a rating whose order is not in fact_orders."""
    day = F.to_date("rating_time") if dated else None
    rated = with_key(ratings, orders, "order_id", "order_key")
    rated = with_version_key(rated, drivers, DRIVERS, day)
    rated = with_version_key(rated, restaurants, RESTAURANTS, day)
    rated = with_date_key(rated, calendar, F.to_date("rating_time"))
    return (rated.withColumn("rating_key", hash_key("rating_id"))
            .select(*GOLD_COLUMNS["fact_ratings"]))


def items_sold(items: DataFrame, orders: DataFrame) -> DataFrame:
    """How many different menu items each restaurant sold per day."""
    sold = items.select("order_id", "item_id").join(
        orders.select("order_id", "restaurant_id", F.to_date("order_time").alias("report_date")), "order_id")
    return (sold.groupBy("report_date", "restaurant_id")
            .agg(F.count_distinct("item_id").cast("int").alias("active_menu_items")))


def fact_restaurant_daily(performance: DataFrame, restaurants: DataFrame, calendar: DataFrame,
                          sold: DataFrame, dated: bool = False) -> DataFrame:
    """Daily performance of known restaurants on calendar days; `sold` comes from `items_sold`."""
    # first, while performance is still hashed on (report_date, restaurant_id)
    daily = performance.join(sold, ["report_date", "restaurant_id"], "left")
    daily = with_version_key(daily, restaurants, RESTAURANTS, F.col("report_date") if dated else None, how="inner")
    daily = with_date_key(daily, calendar, F.col("report_date"), how="inner")
    return daily.withColumns({
        "restaurant_daily_key": hash_key("restaurant_id", "report_date"),
        "active_menu_items": F.coalesce("active_menu_items", F.lit(0)),
    }).select(*GOLD_COLUMNS["fact_restaurant_daily"])


def fact_driver_daily(performance: DataFrame, drivers: DataFrame, calendar: DataFrame,
                      earnings_per_tip: float = EARNINGS_PER_TIP,
                      hours_per_order: float = HOURS_PER_ORDER, dated: bool = False) -> DataFrame:
    daily = with_version_key(performance, drivers, DRIVERS, F.col("report_date") if dated else None, how="inner")
    daily = with_date_key(daily, calendar, F.col("report_date"), how="inner")
    return daily.withColumns({
        "driver_daily_key": hash_key("driver_id", "report_date"),
        "total_earnings": F.col("total_tips") * F.lit(earnings_per_tip),
        "hours_worked": F.col("orders_completed") * F.lit(hours_per_order),
    }).select(*GOLD_COLUMNS["fact_driver_daily"])


def fact_business_summary(orders: DataFrame, ratings: DataFrame, drivers: DataFrame, restaurants: DataFrame,
                          calendar: DataFrame, as_of, period: str = "daily",
                          default_rating: float = DEFAULT_RATING) -> DataFrame:
    """Totals per calendar day, or per day and hour with period='hourly'.

    Facts are summed per period before they meet the calendar, so the join sees
    one row per period. `active_drivers` and `active_restaurants` count current
    dimension rows, active or not.
    """
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}, not {period!r}")
    keys = ["date_key", "period_start"]

    def slots(df: DataFrame, ts: str) -> DataFrame:
        return (df.filter(F.col("date_key").isNotNull())
                .withColumn("period_start", F.date_trunc(PERIODS[period], ts)))

    totals = slots(orders, "order_time").groupBy(*keys).agg(
        F.count("order_key").alias("total_orders"),
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
        X.mean_money(F.col("total_amount")).alias("avg_order_value"),
        # delivery_minutes holds one decimal: its mean is one of tenths
        X.mean_rating(F.col("delivery_minutes")).alias("avg_delivery_time"),
        X.sum_money(F.col("tip_amount")).alias("total_tips"),
        X.share(F.count_if(F.col("sla_breached")), F.count("order_key"), 3).alias("sla_breach_rate"),
    )
    all_marks = (X.tenths(F.col("driver_rating")) + X.tenths(F.col("food_rating"))
                 + X.tenths(F.col("delivery_rating")))
    satisfaction = slots(ratings, "rating_time").groupBy(*keys).agg(
        X.rounded_ratio(F.sum(all_marks), F.count(all_marks), 30, 2).alias("overall_satisfaction"))
    summary = totals.join(satisfaction, keys, "left").join(calendar.select("date_key"), "date_key", "left_semi")
    return summary.withColumns({
        "summary_key": hash_key("period_start", F.lit(period)),
        "time_period": F.lit(period),
        "active_drivers": current(drivers).agg(F.count(F.lit(1))).scalar(),
        "active_restaurants": current(restaurants).agg(F.count(F.lit(1))).scalar(),
        "overall_satisfaction": F.coalesce("overall_satisfaction", F.lit(default_rating)),
        "ingest_timestamp": S.instant(as_of),
    }).select(*GOLD_COLUMNS["fact_business_summary"])


def recent_fact_orders(scored: DataFrame, drivers: DataFrame | None, restaurants: DataFrame | None, as_of,
                       lookback: str = "1 DAY", unknown_key: int = UNKNOWN_KEY) -> DataFrame:
    """Facts of orders processed within `lookback`; an unknown dimension row gets `unknown_key`."""
    recent = scored.filter(S.within(F.col("processing_timestamp"), as_of, lookback))
    keyed = with_key(recent, restaurants, "restaurant_id", "restaurant_key", unknown_key=unknown_key)
    keyed = with_key(keyed, drivers, "driver_id", "driver_key", unknown_key=unknown_key)
    return keyed.select(
        hash_key("order_id").alias("order_key"), "order_id", "customer_id", "restaurant_key", "driver_key",
        F.to_date("order_time").alias("order_date"), "order_time", "delivery_time", "total_amount",
        "tip_amount", F.col("delivery_time_minutes").alias("delivery_minutes"),
        F.col("prep_time_minutes").alias("prep_minutes"), "cancelled", "status", "data_quality_score",
        S.instant(as_of).alias("created_timestamp"),
    )


def customer_activity(scored: DataFrame, as_of, lookback: str = "1 DAY") -> DataFrame:
    recent = scored.filter(S.within(F.col("processing_timestamp"), as_of, lookback))
    return recent.groupBy("customer_id").agg(
        F.max("order_time").alias("last_order_time"),
        F.count(F.lit(1)).alias("recent_order_count"),
    ).withColumn("updated_timestamp", S.instant(as_of))
