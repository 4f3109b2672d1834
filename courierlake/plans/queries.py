"""Every operator as a query over the whole given tables: name -> (spark, folder) -> DataFrame."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.functions.keys import numbered, registered
from courierlake.operators import clean, daily, dims, facts, late, merge, reconcile, reports, rollups, rules
from courierlake.schemas import WIRE_ORDER_ITEMS, WIRE_ORDERS
from courierlake.session import checkpoint_root
from courierlake.sources import wire
from courierlake.sources.given import AS_OF, FIRST_LOAD, Given
from courierlake.streaming import refine

SECOND_LOAD = "1998-07-01 00:00:00"
THIRD_LOAD = "2000-02-01 00:00:00"
LOOKBACK = "365 DAYS"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = f(Given(spark, folder))
        zoned = [c.name for c in df.schema.fields if c.dataType.typeName() == "timestamp"]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    QUERIES[f.__name__] = run
    return f


# --- sources --------------------------------------------------------------------

@query
def json_decode(g: Given) -> DataFrame:
    return g.table("events").select(
        "event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query
def decode_orders(g: Given) -> DataFrame:
    messages = wire.encode(g.bronze_orders(), WIRE_ORDERS)
    return wire.readable(wire.decode_orders(messages))


@query
def decode_order_items(g: Given) -> DataFrame:
    whole = g.bronze_order_items().withColumn("quantity", F.col("quantity").cast("int"))
    return wire.readable(wire.decode_order_items(wire.encode(whole, WIRE_ORDER_ITEMS)))


# --- silver ---------------------------------------------------------------------

@query
def silver_orders(g: Given) -> DataFrame:
    return g.silver_orders()


@query
def silver_order_items(g: Given) -> DataFrame:
    return g.silver_order_items()


@query
def silver_menu_items(g: Given) -> DataFrame:
    return g.silver_menu_items()


@query
def silver_drivers(g: Given) -> DataFrame:
    return g.silver_drivers()


@query
def silver_restaurants(g: Given) -> DataFrame:
    return g.silver_restaurants()


@query
def silver_ratings(g: Given) -> DataFrame:
    return g.silver_ratings()


@query
def silver_weather(g: Given) -> DataFrame:
    return clean.clean_weather(g.bronze_weather(), AS_OF)


@query
def silver_locations(g: Given) -> DataFrame:
    return clean.clean_locations(g.bronze_locations(), AS_OF)


@query
def restaurant_performance(g: Given) -> DataFrame:
    return daily.restaurant_performance(g.silver_orders(drivers=False), g.silver_ratings(), AS_OF)


@query
def driver_performance(g: Given) -> DataFrame:
    return daily.driver_performance(g.silver_orders(), g.silver_ratings(restaurants=False), AS_OF)


@query
def scored_orders(g: Given) -> DataFrame:
    return g.scored_orders()


@query
def quality_score(g: Given) -> DataFrame:
    arrived = F.when(F.col("status") != "preparing", F.col("order_time"))
    score = S.quality_score(F.col("order_id"), F.col("customer_id"), F.col("restaurant_id"),
                            F.col("tip_amount"), arrived)
    return g.bronze_orders(drivers=False).select("order_id", score.alias("data_quality_score"))


@query
def daily_performance(g: Given) -> DataFrame:
    return daily.daily_performance(g.scored_orders(), AS_OF, lookback=None)


@query
def recent_daily_performance(g: Given) -> DataFrame:
    return daily.daily_performance(g.scored_orders(), AS_OF, lookback=LOOKBACK)


# --- dimensions -----------------------------------------------------------------

@query
def dim_date(g: Given) -> DataFrame:
    return dims.calendar_of(g.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("start_date"), F.to_date(F.max("o_orderdate")).alias("end_date")))


@query
def dim_keys(g: Given) -> DataFrame:
    return numbered(g.silver_drivers().select("driver_id"), "driver_id", "driver_key")


@query
def dim_drivers(g: Given) -> DataFrame:
    return g.dim_drivers()


@query
def dim_restaurants(g: Given) -> DataFrame:
    return g.dim_restaurants()


@query
def dim_menu_items(g: Given) -> DataFrame:
    return g.dim_menu_items()


@query
def scd2_drivers(g: Given) -> DataFrame:
    return dims.scd2(g.earlier_drivers(), g.later_drivers(), dims.DRIVERS, SECOND_LOAD)


@query
def scd2_restaurants(g: Given) -> DataFrame:
    return dims.scd2(g.earlier_restaurants(), g.later_restaurants(), dims.RESTAURANTS, SECOND_LOAD)


@query
def scd2_as_of(g: Given) -> DataFrame:
    history = dims.scd2(g.earlier_restaurants(), g.later_restaurants(), dims.RESTAURANTS, SECOND_LOAD)
    orders = g.silver_orders(drivers=False).select("order_id", "restaurant_id", "order_time")
    return dims.lookup_as_of(orders, history, dims.RESTAURANTS, F.to_date("order_time"))


def _loads(first: DataFrame, second: DataFrame, third: DataFrame) -> DataFrame:
    """Three snapshots of a dimension; the one loaded last is not the newest."""
    def at(df: DataFrame, when: str) -> DataFrame:
        return df.withColumn("loaded_at", F.lit(when).cast("timestamp"))

    return at(second, SECOND_LOAD).unionByName(at(third, THIRD_LOAD)).unionByName(at(first, FIRST_LOAD))


@query
def scd2_rebuilt(g: Given) -> DataFrame:
    """The first names come back with the third load, so a version may return."""
    first = g.silver_restaurants().filter("is_active")
    return dims.history_of(_loads(first, g.later_restaurants(), g.silver_restaurants()), dims.RESTAURANTS)


@query
def restaurant_registry(g: Given) -> DataFrame:
    """Keys over three loads: the active restaurants, all of them, then those with an address only."""
    registry = None
    for load in (g.silver_restaurants().filter("is_active"), g.silver_restaurants(),
                 g.later_restaurants().filter("address is not null")):
        registry = registered(registry, load, "restaurant_id", "restaurant_key")
    return registry


# --- facts ----------------------------------------------------------------------

@query
def fact_orders(g: Given) -> DataFrame:
    return g.fact_orders()


@query
def fact_orders_as_of(g: Given) -> DataFrame:
    """Order facts with the keys of the dimension versions of their day, over two loads."""
    drivers = dims.scd2(g.earlier_drivers(), g.later_drivers(), dims.DRIVERS, SECOND_LOAD)
    restaurants = dims.scd2(g.earlier_restaurants(), g.later_restaurants(), dims.RESTAURANTS, SECOND_LOAD)
    return facts.fact_orders(g.silver_orders(), drivers, restaurants, g.calendar, dated=True)


@query
def fact_order_items(g: Given) -> DataFrame:
    return facts.fact_order_items(
        g.silver_order_items(), g.fact_orders(drivers=False, restaurants=False, dates=False),
        g.dim_menu_items(), g.calendar)


@query
def fact_ratings(g: Given) -> DataFrame:
    return g.fact_ratings()


@query
def fact_restaurant_daily(g: Given) -> DataFrame:
    orders = g.silver_orders(drivers=False)
    performance = daily.restaurant_performance(orders, g.silver_ratings(), AS_OF)
    sold = facts.items_sold(g.silver_order_items(), orders)
    return facts.fact_restaurant_daily(performance, g.dim_restaurants(), g.calendar, sold)


@query
def fact_driver_daily(g: Given) -> DataFrame:
    performance = daily.driver_performance(g.silver_orders(), g.silver_ratings(restaurants=False), AS_OF)
    return facts.fact_driver_daily(performance, g.dim_drivers(), g.calendar)


@query
def business_summary(g: Given) -> DataFrame:
    return g.business_summary()


@query
def business_summary_hourly(g: Given) -> DataFrame:
    return g.business_summary("hourly")


@query
def recent_fact_orders(g: Given) -> DataFrame:
    return facts.recent_fact_orders(g.scored_orders(), g.dim_drivers(), g.dim_restaurants(), AS_OF, LOOKBACK)


@query
def customer_activity(g: Given) -> DataFrame:
    return facts.customer_activity(g.scored_orders(drivers=False), AS_OF, LOOKBACK)


# --- updates, late data -----------------------------------------------------------

@query
def dedup_latest(g: Given) -> DataFrame:
    return merge.dedup_latest(g.table("events"), ["user_id"], ["ts", "event_id"])


def _reported(g: Given) -> DataFrame:
    """Three events each report on one order; the latest counts."""
    reports_ = g.table("events").select(
        (F.floor(F.col("event_id") / 3) * 2).alias("order_id"), F.col("event_type").alias("status"),
        F.col("ts").alias("delivery_time"), "event_id")
    return merge.dedup_latest(reports_, ["order_id"], ["delivery_time", "event_id"]).drop("event_id")


@query
def upsert_status(g: Given) -> DataFrame:
    target = g.bronze_orders(drivers=False).select("order_id", "customer_id", "status", "delivery_time")
    return merge.upsert(target, _reported(g), ["order_id"], ["status", "delivery_time"], insert=True)


@query
def merged_months(g: Given) -> DataFrame:
    """The same reports merged into a catalog table that is split by month; the table stays in the warehouse."""
    spark, table = g.spark, f"merged_months_{uuid.uuid4().hex}"
    month = F.trunc("order_time", "month").alias("order_month")
    orders = g.bronze_orders(drivers=False).select("order_id", "customer_id", "status", "delivery_time", month)
    orders.hint("rebalance", F.col("order_month")).write.partitionBy("order_month").saveAsTable(table)
    latest = _reported(g).withColumn("order_month", F.trunc("delivery_time", "month"))
    merge.merge_into(spark, table, latest, ["order_id"], ["status", "delivery_time"],
                     checkpoint_root(spark, spark.conf.get("spark.sql.warehouse.dir")), insert=True)
    return spark.table(table)


def _arrived(g: Given) -> DataFrame:
    delay = F.make_dt_interval(hours=F.pmod("event_id", F.lit(73)).cast("int"))
    return g.table("events").select("event_id", "event_type", "ts", (F.col("ts") + delay).alias("arrival_time"))


@query
def lateness(g: Given) -> DataFrame:
    return late.classify_lateness(_arrived(g), "ts", "arrival_time")


@query
def lateness_summary(g: Given) -> DataFrame:
    return late.lateness_summary(late.classify_lateness(_arrived(g), "ts", "arrival_time"))


@query
def recent_orders(g: Given) -> DataFrame:
    orders = g.bronze_orders(lines=False, drivers=False)
    return late.recent(orders, "order_time", AS_OF, LOOKBACK).select("order_id", "order_time", "status")


@query
def late_confirmations(g: Given) -> DataFrame:
    orders = g.bronze_orders(drivers=False).select("order_id", "order_time", "status", "delivery_time")
    return late.apply_confirmations(orders, late.delivery_reports(late.incomplete_orders(orders), AS_OF))


@query
def late_impact(g: Given) -> DataFrame:
    def summary(orders: DataFrame) -> DataFrame:
        return (orders.groupBy(F.to_date("order_time").alias("order_date"))
                .agg(F.count(F.lit(1)).alias("orders"), X.sum_money(F.col("total_amount")).alias("revenue")))

    orders = g.bronze_orders(lines=False, drivers=False)
    return late.impact_report(summary(orders.filter("status <> 'preparing'")), summary(orders),
                              ["order_date"], ["orders", "revenue"])


@query
def daily_windows(g: Given) -> DataFrame:
    # the estimate of distinct customers is for streams; the exact counts are compared here
    return refine.daily_windows(g.silver_orders(drivers=False)).drop("customers_estimate")


# --- content of layers, sketches ----------------------------------------------------

@query
def layer_fingerprints(g: Given) -> DataFrame:
    found = reconcile.fingerprints(g.silver_orders(drivers=False), F.to_date("order_time"), "order_id",
                                   reconcile.order_columns())
    return found.withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query
def content_differences(g: Given) -> DataFrame:
    """What cleaning changed: bronze orders against silver ones, day by day, then by key."""
    day = F.to_date("order_time")
    return reconcile.differing_rows(g.bronze_orders(drivers=False), g.silver_orders(drivers=False), day, day, "order_id",
                                    reconcile.order_columns())


@query
def customers_by_month(g: Given) -> DataFrame:
    """Estimates from sketches per day and restaurant; no SQL gives the same numbers."""
    sketches = rollups.customer_sketches(g.silver_orders(drivers=False))
    return rollups.distinct_customers(sketches, F.trunc("day", "MM").alias("month"))


# --- quality ----------------------------------------------------------------------

@query
def dq_orders(g: Given) -> DataFrame:
    return rules.quality_metrics(g.bronze_orders(drivers=False),
                                 rules.required("order_id", "customer_id", "restaurant_id"))


@query
def dq_items(g: Given) -> DataFrame:
    return rules.quality_metrics(g.bronze_order_items(), [rules.positive("quantity"), rules.positive("item_price")])


@query
def dq_ratings(g: Given) -> DataFrame:
    return rules.quality_metrics(g.bronze_ratings(restaurants=False), rules.rating_bounds())


@query
def rejected_ratings(g: Given) -> DataFrame:
    broken = rules.rejected(g.bronze_ratings(restaurants=False), rules.rating_rules())
    return broken.select("rating_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def rejected_orders(g: Given) -> DataFrame:
    broken = rules.rejected(g.bronze_orders(drivers=False), rules.order_rules())
    return broken.select("order_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def orphan_lines(g: Given) -> DataFrame:
    """Lines of orders that no rating names."""
    rated = g.table("events").select(F.col("event_id").alias("order_id"))
    return rules.orphans(g.bronze_order_items(), rated, "order_id").select("order_item_id", "order_id", "item_id")


@query
def dq_references(g: Given) -> DataFrame:
    """Lines whose order no rating names, counted as a rule of the gate."""
    rated = g.table("events").select(F.col("event_id").alias("order_id"))
    return rules.orphan_metrics(g.bronze_order_items(), rated, "order_id", "order_id has no rating")


@query
def touched_days(g: Given) -> DataFrame:
    """The days of orders that late ratings belong to: what a rebuild after them has to read."""
    ratings = g.bronze_ratings(restaurants=False).filter("rating_type = 'purchase'")
    orders = g.bronze_orders(lines=False, drivers=False)
    days = late.touched_dates(orders.join(ratings.select("order_id").distinct(), "order_id", "left_semi"),
                              "order_time", AS_OF)
    return days.toDF("day").distinct()


@query
def orphan_ratings(g: Given) -> DataFrame:
    """Ratings of orders that do not exist."""
    ratings = g.table("events").select(F.col("event_id").alias("rating_id"), F.col("event_id").alias("order_id"))
    return rules.orphans(ratings, g.table("orders").select(F.col("o_orderkey").alias("order_id")), "order_id")


@query
def core_metrics_net(g: Given) -> DataFrame:
    """Core metrics of amounts with many decimals: net line prices, summed per order."""
    exact = [F.col(c).cast("decimal(12,2)") for c in ("l_extendedprice", "l_discount", "l_tax")]
    net = (exact[0] * (1 - exact[1]) * (1 + exact[2])).cast("decimal(20,6)")
    lines = g.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(net).cast("double").alias("total_amount"), F.min("l_suppkey").alias("restaurant_id"))
    orders = g.bronze_orders(lines=False, drivers=False).select("order_id", "customer_id", "status")
    return reports.core_metrics(orders.join(lines, "order_id"))


@query
def layer_counts(g: Given) -> DataFrame:
    return reports.layer_counts({
        ("bronze", "bronze_orders"): g.bronze_orders(lines=False, drivers=False),
        ("bronze", "bronze_order_items"): g.bronze_order_items(),
        ("bronze", "bronze_ratings"): g.bronze_ratings(restaurants=False),
        ("silver", "silver_orders"): g.silver_orders(drivers=False),
        ("gold", "fact_orders"): g.fact_orders(drivers=False, restaurants=False, dates=False),
        ("gold", "fact_order_items"): facts.fact_order_items(
            g.silver_order_items(), g.fact_orders(drivers=False, restaurants=False, dates=False), None, None),
        ("gold", "fact_ratings"): g.fact_ratings(drivers=False, restaurants=False, dates=False),
    })


# --- reports ----------------------------------------------------------------------

def _plain_facts(g: Given) -> DataFrame:
    """Order facts for reports that read no dimension key."""
    return g.fact_orders(drivers=False, restaurants=False, dates=False)


def _restaurant_facts(g: Given) -> DataFrame:
    return g.fact_orders(drivers=False, dates=False)


@query
def order_detail(g: Given) -> DataFrame:
    return reports.order_detail(g.fact_orders(dates=False), g.dim_restaurants(), g.dim_drivers())


@query
def status_breakdown(g: Given) -> DataFrame:
    return reports.status_breakdown(_plain_facts(g))


@query
def status_share(g: Given) -> DataFrame:
    return reports.status_share(g.bronze_orders(lines=False, drivers=False))


@query
def orders_by_restaurant(g: Given) -> DataFrame:
    return reports.orders_by_restaurant(_restaurant_facts(g), g.dim_restaurants())


@query
def orders_by_date(g: Given) -> DataFrame:
    return reports.orders_by_date(_plain_facts(g))


@query
def revenue_stats(g: Given) -> DataFrame:
    return reports.revenue_stats(_plain_facts(g))


@query
def revenue_summary(g: Given) -> DataFrame:
    return reports.revenue_summary(_plain_facts(g))


@query
def core_metrics(g: Given) -> DataFrame:
    return reports.core_metrics(g.bronze_orders(drivers=False))


@query
def customer_value(g: Given) -> DataFrame:
    return reports.customer_value(g.bronze_orders(lines=False, drivers=False))


@query
def peak_hours(g: Given) -> DataFrame:
    return reports.peak_hours(g.bronze_orders(lines=False, drivers=False), "order_time")


@query
def delivery_stats(g: Given) -> DataFrame:
    return reports.delivery_stats(g.bronze_orders())


@query
def cuisine_performance(g: Given) -> DataFrame:
    return reports.cuisine_performance(g.bronze_orders(drivers=False), g.bronze_restaurants(), g.silver_ratings())


@query
def metric_rows(g: Given) -> DataFrame:
    return reports.metric_rows(_plain_facts(g))


@query
def order_totals(g: Given) -> DataFrame:
    return reports.order_totals(_plain_facts(g))


@query
def top_restaurants(g: Given) -> DataFrame:
    return reports.top_restaurants(_restaurant_facts(g), g.dim_restaurants())


@query
def top_restaurants_rated(g: Given) -> DataFrame:
    marks = g.fact_ratings(orders=False, drivers=False, restaurants=False, dates=False)
    return reports.top_restaurants_rated(_restaurant_facts(g), marks, g.dim_restaurants())


@query
def top_drivers(g: Given) -> DataFrame:
    marks = g.fact_ratings(orders=False, drivers=False, restaurants=False, dates=False)
    return reports.top_drivers(g.fact_orders(restaurants=False, dates=False), marks, g.dim_drivers())


@query
def daily_trends(g: Given) -> DataFrame:
    return reports.daily_trends(g.fact_orders(drivers=False, restaurants=False), g.calendar)


@query
def rating_summary(g: Given) -> DataFrame:
    return reports.rating_summary(g.silver_ratings(restaurants=False))


@query
def top_rated(g: Given) -> DataFrame:
    return reports.top_rated(g.fact_ratings(orders=False, drivers=False, dates=False), g.dim_restaurants())


@query
def latest_summary(g: Given) -> DataFrame:
    return reports.latest_summary(g.business_summary())


@query
def synth_stats(g: Given) -> DataFrame:
    return reports.bronze_stats(g.bronze_orders(drivers=False), g.silver_ratings(restaurants=False))
