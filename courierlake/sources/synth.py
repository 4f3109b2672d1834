"""Orders, lines, ratings and reference tables made on the executors.

Every value is drawn from a hash of (row id, purpose, seed): the same rows come
out for a seed whatever the partitioning, and nothing passes through the driver.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions import scalars as S
from courierlake.schemas import BRONZE

# Shares, ranges and sizes of the generated order history.
HISTORY_DAYS = 30
PEAK_SHARE = 0.6
LUNCH_HOURS = (12, 14)
DINNER_HOURS = (18, 21)
OPEN_HOURS = (9, 23)
RUSH_HOURS = [12, 13, 19, 20]
LINE_COUNT_SHARES = [(1, 0.4), (2, 0.3), (3, 0.2), (4, 0.07), (5, 0.03)]
QUANTITY_SHARES = [(1, 0.7), (2, 0.25), (3, 0.05)]
PRICE_RANGE = (8.0, 35.0)
RUSH_DELIVERY = (25, 75)
CALM_DELIVERY = (15, 45)
DELIVERED_SHARE = 0.88
RATED_SHARE = 0.7
SERVICE_MARKS = [(3, 0.1), (4, 0.3), (5, 0.6)]
FOOD_MARKS = [(3, 0.15), (4, 0.35), (5, 0.5)]
DRIVERS, RESTAURANTS, ITEMS, CUSTOMERS = 200, 15, 300, 1500


@dataclass(frozen=True)
class Bronze:
    orders: DataFrame
    order_items: DataFrame
    ratings: DataFrame


class _Draw:
    """Uniform draws for the row identified by `ids`."""

    def __init__(self, seed: int, *ids: Column):
        self.seed, self.ids = seed, ids

    def unit(self, purpose: str) -> Column:
        spread = F.xxhash64(*self.ids, F.lit(purpose), F.lit(self.seed))
        return F.pmod(spread, F.lit(1 << 52)) / F.lit(float(1 << 52))

    def whole(self, purpose: str, low: int, high: int) -> Column:
        return (F.floor(self.unit(purpose) * (high - low + 1)) + low).cast("int")

    def between(self, purpose: str, low: float, high: float) -> Column:
        return self.unit(purpose) * (high - low) + low

    def pick(self, purpose: str, shares: list[tuple[int, float]]) -> Column:
        u = self.unit(purpose)
        upper, rungs = 0.0, []
        for value, part in shares[:-1]:
            upper += part
            rungs.append(F.when(u < upper, F.lit(value)))
        return F.coalesce(*rungs, F.lit(shares[-1][0]))


def _coded(prefix: str, number: Column, width: int) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number)


def _later(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes.cast("int"))


def _as_bronze(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE[table]])


def synth_orders(spark: SparkSession, n: int, seed: int, as_of, partitions: int | None = None,
                 days: int = HISTORY_DAYS) -> Bronze:
    """n orders over the `days` before as_of, their lines, and ratings for most delivered ones."""
    draw = _Draw(seed, F.col("id"))
    ids = spark.range(1, n + 1, 1, partitions) if partitions else spark.range(1, n + 1)

    in_peak = draw.unit("peak") < PEAK_SHARE
    hour = (F.when(in_peak & (draw.unit("meal") < 0.5), draw.whole("lunch", *LUNCH_HOURS))
            .when(in_peak, draw.whole("dinner", *DINNER_HOURS))
            .otherwise(draw.whole("hour", *OPEN_HOURS)))
    first_day = F.date_sub(F.to_date(S.instant(as_of)), days)
    day = F.date_add(first_day, draw.whole("day", 0, days - 1))
    opened = ids.select(
        "id", day.alias("day"), hour.alias("hour"),
        draw.pick("lines", LINE_COUNT_SHARES).alias("line_count"),
        _coded("order_", F.col("id"), 6).alias("order_id"),
        _coded("customer_", draw.whole("customer", 1, CUSTOMERS), 4).alias("customer_id"),
        _coded("rest_", draw.whole("restaurant", 1, RESTAURANTS), 3).alias("restaurant_id"),
        _coded("driver_", draw.whole("driver", 1, DRIVERS), 3).alias("driver_id"),
        F.when(draw.unit("status") < DELIVERED_SHARE, F.lit("delivered")).otherwise(F.lit("cancelled"))
        .alias("status"),
    ).withColumn("order_time", F.col("day").cast("timestamp") + F.make_dt_interval(
        hours=F.col("hour"), mins=draw.whole("minute", 0, 59)))

    def line(number: Column) -> Column:
        own = _Draw(seed, F.col("id"), number)
        return F.struct(
            number.alias("number"), own.whole("item", 1, ITEMS).alias("item"),
            own.pick("quantity", QUANTITY_SHARES).alias("quantity"),
            F.round(own.between("price", *PRICE_RANGE), 2).alias("item_price"))

    # five lines are drawn and the first line_count kept: an order's total needs no join
    drawn = F.array(*[line(F.lit(k)) for k, _ in LINE_COUNT_SHARES])
    filled = opened.withColumn("lines", F.slice(drawn, F.lit(1), F.col("line_count")))

    items = filled.select("order_id", "order_time", F.inline("lines")).select(
        F.concat("order_id", F.lit("_item_"), F.col("number").cast("string")).alias("order_item_id"),
        "order_id", _coded("item_", F.col("item"), 4).alias("item_id"), "quantity", "item_price", "order_time")

    is_rush = F.col("hour").isin(RUSH_HOURS)
    minutes = F.when(is_rush, draw.whole("rush", *RUSH_DELIVERY)).otherwise(draw.whole("calm", *CALM_DELIVERY))
    prep = F.greatest(F.lit(10), F.col("line_count") * 5 + 15 + draw.whole("prep", -5, 15))
    generous = (F.weekday("day") >= 5) | (F.col("hour") >= DINNER_HOURS[0])
    tip = F.when(generous, draw.between("tip", 3.0, 12.0)).otherwise(draw.between("tip", 1.0, 8.0))
    total = F.aggregate("lines", F.lit(0.0), lambda acc, x: acc + x["quantity"] * x["item_price"])
    served = filled.withColumns({
        "delivered_at": _later(F.col("order_time"), minutes),
        "prep_start_time": _later(F.col("order_time"), draw.whole("start", 2, 8)),
    })
    orders = served.withColumns({
        "delivery_time": F.when(F.col("status") == "delivered", F.col("delivered_at")),
        "prep_end_time": _later(F.col("prep_start_time"), prep),
        "total_amount": F.round(total, 2),
        "tip_amount": F.round(tip, 2),
    })

    def mark(purpose: str, shares: list[tuple[int, float]]) -> Column:
        raw = draw.pick(purpose, shares) + draw.between(purpose + " spread", -0.5, 0.5)
        return F.round(F.least(F.lit(5.0), F.greatest(F.lit(1.0), raw)), 1)

    rated = served.filter((F.col("status") == "delivered") & (draw.unit("rated") < RATED_SHARE))
    ratings = rated.select(
        _coded("rating_", F.col("id"), 6).alias("rating_id"), "order_id", "driver_id", "restaurant_id",
        mark("driver mark", SERVICE_MARKS).alias("driver_rating"),
        mark("food mark", FOOD_MARKS).alias("food_rating"),
        mark("delivery mark", SERVICE_MARKS).alias("delivery_rating"),
        _later(F.col("delivered_at"), draw.whole("rated at", 10, 120)).alias("rating_time"),
        F.lit("order_completion").alias("rating_type"))
    return Bronze(_as_bronze(orders, "orders"), _as_bronze(items, "order_items"), _as_bronze(ratings, "ratings"))


# --- reference tables --------------------------------------------------------

# Labels the reference tables draw from.
CUISINES = ["Italian", "American", "Japanese", "Mexican", "Indian", "Chinese", "Thai", "Greek"]
VEHICLES = ["car", "motorcycle", "bicycle"]
CATEGORIES = ["main", "side", "salad", "soup"]
CONDITIONS = ["sunny", "cloudy", "rainy", "partly_cloudy"]


def _one_of(draw: _Draw, purpose: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), draw.whole(purpose, 1, len(values)))


def synth_restaurants(spark: SparkSession, n: int = RESTAURANTS, seed: int = 0) -> DataFrame:
    draw = _Draw(seed, F.col("id"))
    return _as_bronze(spark.range(1, n + 1).select(
        _coded("rest_", F.col("id"), 3).alias("restaurant_id"),
        F.concat(F.lit("Restaurant "), F.col("id").cast("string")).alias("name"),
        _one_of(draw, "cuisine", CUISINES).alias("cuisine_type"),
        F.concat(F.col("id").cast("string"), F.lit(" Main St")).alias("address"),
        _coded("555-", F.col("id") + 100, 4).alias("phone"),
        F.round(draw.between("rating", 3.5, 5.0), 1).alias("rating"),
        F.lit(True).alias("is_active")), "restaurants")


def synth_drivers(spark: SparkSession, n: int = 20, seed: int = 0) -> DataFrame:
    draw = _Draw(seed, F.col("id"))
    return _as_bronze(spark.range(1, n + 1).select(
        _coded("driver_", F.col("id"), 3).alias("driver_id"),
        F.concat(F.lit("Driver "), F.col("id").cast("string")).alias("name"),
        _coded("555-", F.col("id") + 2000, 4).alias("phone"),
        _one_of(draw, "vehicle", VEHICLES).alias("vehicle_type"),
        F.round(draw.between("rating", 3.5, 5.0), 1).alias("rating"),
        (draw.unit("active") < 0.75).alias("is_active")), "drivers")


def synth_menu_items(spark: SparkSession, n: int = 13, restaurants: int = RESTAURANTS, seed: int = 0) -> DataFrame:
    draw = _Draw(seed, F.col("id"))
    return _as_bronze(spark.range(1, n + 1).select(
        _coded("item_", F.col("id"), 4).alias("item_id"),
        _coded("rest_", F.pmod(F.col("id"), F.lit(restaurants)) + 1, 3).alias("restaurant_id"),
        F.concat(F.lit("Dish "), F.col("id").cast("string")).alias("name"),
        F.lit("house recipe").alias("description"),
        F.round(draw.between("price", 4.0, 16.0), 2).alias("price"),
        F.lit(True).alias("is_available"),
        _one_of(draw, "category", CATEGORIES).alias("category")), "menu_items")


def synth_weather(spark: SparkSession, as_of, days: int = HISTORY_DAYS, seed: int = 0) -> DataFrame:
    draw = _Draw(seed, F.col("id"))
    day = F.date_sub(F.to_date(S.instant(as_of)), (F.lit(days) - F.col("id")).cast("int"))
    return _as_bronze(spark.range(days).select(
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.round(draw.between("temperature", 15.0, 35.0), 1).alias("temperature_celsius"),
        draw.whole("humidity", 30, 90).alias("humidity_percent"),
        _one_of(draw, "conditions", CONDITIONS).alias("conditions"),
        F.round(draw.between("wind", 0.0, 25.0), 1).alias("wind_speed_kmh")), "weather")


def synth_lake(lake, n: int, seed: int, as_of, days: int = HISTORY_DAYS) -> dict[str, int]:
    """Fill the bronze layer of a lake; returns the rows written per table."""
    made = synth_orders(lake.spark, n, seed, as_of, days=days)
    frames = {
        "orders": made.orders, "order_items": made.order_items, "ratings": made.ratings,
        "restaurants": synth_restaurants(lake.spark, seed=seed),
        "drivers": synth_drivers(lake.spark, seed=seed),
        "menu_items": synth_menu_items(lake.spark, seed=seed),
        "weather": synth_weather(lake.spark, as_of, days, seed),
    }
    return {t: lake.replace(df, "bronze", f"bronze_{t}") for t, df in frames.items()}
