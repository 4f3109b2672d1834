"""Bronze to silver: one narrow pass per table, no shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions import scalars as S
from courierlake.operators import rules
from courierlake.schemas import SILVER_COLUMNS


def _finish(df: DataFrame, table: str, as_of) -> DataFrame:
    return df.withColumn("ingest_timestamp", S.instant(as_of)).select(*SILVER_COLUMNS[table])


def _prep_minutes() -> Column:
    return S.minutes_between(F.col("prep_end_time"), F.col("prep_start_time"))


def clean_orders(bronze: DataFrame, as_of) -> DataFrame:
    valid = rules.keep(bronze, rules.order_rules())
    ordered = S.clamp_future(F.col("order_time"), as_of)
    delivered = S.null_if_before(F.col("delivery_time"), ordered)
    cleaned = valid.select(
        "order_id", "customer_id", "restaurant_id", "driver_id", "status",
        ordered.alias("order_time"),
        delivered.alias("delivery_time"),
        S.money_floor(F.col("total_amount")).alias("total_amount"),
        _prep_minutes().alias("prep_time_minutes"),
        S.minutes_between(delivered, ordered).alias("delivery_time_minutes"),
        S.money_floor(F.col("tip_amount")).alias("tip_amount"),
        S.is_cancelled(F.col("status")).alias("cancelled"),
    )
    return _finish(cleaned, "orders", as_of)


def clean_order_items(bronze: DataFrame, as_of) -> DataFrame:
    """Also serves a stream of items: nothing here needs more than the row."""
    quantity = F.col("quantity").try_cast("int")
    price = F.round("item_price", 2)
    cleaned = rules.keep(bronze, rules.order_item_rules()).select(
        "order_item_id", "order_id", "item_id",
        quantity.alias("quantity"),
        price.alias("item_price"),
        S.extended_price(quantity, price).alias("extended_price"),
        "order_time",
    )
    return _finish(cleaned, "order_items", as_of)


def clean_menu_items(bronze: DataFrame, as_of) -> DataFrame:
    cleaned = rules.keep(bronze, rules.menu_item_rules()).select(
        "item_id", "restaurant_id",
        F.trim("name").alias("item_name"),
        S.default_label(F.col("category"), "Other").alias("category"),
        F.round("price", 2).alias("base_price"),
    )
    return _finish(cleaned, "menu_items", as_of)


def clean_drivers(bronze: DataFrame, as_of) -> DataFrame:
    cleaned = rules.keep(bronze, rules.driver_rules()).withColumns({
        "name": F.trim("name"),
        "vehicle_type": S.default_label(F.col("vehicle_type"), "Unknown"),
    })
    return _finish(cleaned, "drivers", as_of)


def clean_restaurants(bronze: DataFrame, as_of) -> DataFrame:
    cleaned = rules.keep(bronze, rules.restaurant_rules()).withColumns({
        "restaurant_name": F.trim("name"),
        "cuisine_type": S.default_label(F.col("cuisine_type"), "Other"),
    })
    return _finish(cleaned, "restaurants", as_of)


def clean_ratings(bronze: DataFrame, as_of) -> DataFrame:
    marks = ("driver_rating", "food_rating", "delivery_rating")
    cleaned = rules.keep(bronze, rules.rating_rules()).withColumns({
        **{c: F.round(c, 1) for c in marks},
        "rating_type": S.default_label(F.col("rating_type"), "unknown"),
    })
    return _finish(cleaned, "ratings", as_of)


def clean_weather(bronze: DataFrame, as_of) -> DataFrame:
    """`date` arrives as text; text that is no date becomes null and is dropped with the missing ones."""
    dated = bronze.withColumn("date", F.col("date").try_cast("date"))
    cleaned = rules.keep(dated, rules.weather_rules()).withColumns({
        "temperature_celsius": F.round("temperature_celsius", 1),
        "conditions": S.default_label(F.col("conditions"), "Unknown"),
        "wind_speed_kmh": F.round("wind_speed_kmh", 1),
    })
    return _finish(cleaned, "weather", as_of)


def score_orders(bronze: DataFrame, as_of) -> DataFrame:
    """Lenient orders for streams: only order_id is required, the rest lowers the quality score.

    Needs `arrival_time`, the moment the broker or the file system took the record.
    """
    return rules.keep(bronze, rules.required("order_id")).select(
        "order_id", "customer_id", "restaurant_id", "driver_id", "status", "order_time", "delivery_time",
        "total_amount", "tip_amount", "arrival_time",
        _prep_minutes().alias("prep_time_minutes"),
        S.minutes_between(F.col("delivery_time"), F.col("order_time")).alias("delivery_time_minutes"),
        S.is_cancelled(F.col("status")).alias("cancelled"),
        S.quality_score(F.col("order_id"), F.col("customer_id"), F.col("restaurant_id"),
                        F.col("total_amount"), F.col("arrival_time")).alias("data_quality_score"),
        S.instant(as_of).alias("processing_timestamp"),
    )


def clean_locations(bronze: DataFrame, as_of) -> DataFrame:
    return rules.keep(bronze, rules.location_rules()).withColumn("processing_timestamp", S.instant(as_of))
