"""Bronze frames made from the given star-schema tables, for queries and tests.

`FIXTURES.md` lists the mapping. Each bronze order needs up to two joins, and a
query that reads none of the columns behind a join leaves it out.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions.exact import cents
from courierlake.operators import clean, dims, facts
from courierlake.session import size_shuffles, tune

AS_OF = "2001-07-01 00:00:00"
FIRST_LOAD = "1995-01-01 00:00:00"
CALENDAR = dims.calendar_span(AS_OF, days_back=3650, days_ahead=730)

# Order states that stand for the given status letters.
STATUS = {"F": "delivered", "O": "cancelled", "P": "preparing"}


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}


class Given:
    """Lazy bronze, silver and gold frames over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        size_shuffles(spark, self.folder)

    def table(self, name: str) -> DataFrame:
        """A given table under its declared schema: no footer job, and zoneless times read as UTC instants."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- bronze -------------------------------------------------------------

    @staticmethod
    def _order_time() -> Column:
        # the given dates are all midnight; the key spreads orders over the hours
        hours = F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int")
        return F.col("o_orderdate") + F.make_dt_interval(hours=hours)

    def _lines_per_order(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.min("l_suppkey").alias("restaurant_id"),
            F.min("l_shipdate").alias("delivery_time"),
            F.max("l_shipdate").alias("prep_end_time"),
        )

    def bronze_orders(self, lines: bool = True, drivers: bool = True) -> DataFrame:
        """`lines` brings restaurant, delivery and prep end; `drivers` brings the driver."""
        status = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in STATUS.items()])
        tip_cents = F.call_function("div", cents(F.col("o_totalprice")) * 5 + 50, F.lit(100)) - 250_000
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            self._order_time().alias("order_time"),
            status.alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            self._order_time().alias("prep_start_time"),
            (tip_cents / F.lit(100.0)).alias("tip_amount"),
        )
        if lines:
            orders = orders.join(self._lines_per_order(), "order_id", "left")
        if drivers:
            drove = self.table("events").select(
                F.col("event_id").alias("order_id"), F.col("user_id").alias("driver_id"))
            orders = orders.join(drove, "order_id", "left")
        else:
            orders = orders.withColumn("driver_id", F.lit(None).cast("bigint"))
        return orders

    def bronze_order_items(self) -> DataFrame:
        times = self.table("orders").select(F.col("o_orderkey").alias("order_id"),
                                            self._order_time().alias("order_time"))
        prices = self.table("part").select(F.col("p_partkey").alias("item_id"),
                                           F.col("p_retailprice").alias("item_price"))
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"), "l_linenumber",
            F.col("l_quantity").alias("quantity"))
        # the id is text: made behind the joins, it is not shuffled with every line
        return lines.join(prices, "item_id").join(times, "order_id").select(
            "order_id", "item_id", F.concat_ws("_item_", "order_id", "l_linenumber").alias("order_item_id"),
            "quantity", "item_price", "order_time")

    def bronze_restaurants(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                             F.col("n_name").alias("cuisine_type"))
        return self.table("supplier").join(nation, "s_nationkey").select(
            F.col("s_suppkey").alias("restaurant_id"), F.col("s_name").alias("name"), "cuisine_type",
            F.lit(None).cast("string").alias("address"), F.lit(None).cast("string").alias("phone"),
            F.lit(None).cast("double").alias("rating"), (F.col("s_acctbal") >= 0).alias("is_active"))

    def bronze_drivers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("driver_id"), F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("phone"), F.col("c_mktsegment").alias("vehicle_type"),
            F.lit(None).cast("double").alias("rating"), (F.col("c_acctbal") >= 0).alias("is_active"))

    def bronze_menu_items(self) -> DataFrame:
        sold_by = self.table("lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(
            F.min("l_suppkey").alias("restaurant_id"))
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
            F.lit(None).cast("string").alias("description"), F.col("p_retailprice").alias("price"),
            F.lit(True).alias("is_available"), F.col("p_type").alias("category"),
        ).join(sold_by, "item_id", "left")

    def bronze_ratings(self, restaurants: bool = True) -> DataFrame:
        places = self.bronze_orders(lines=restaurants, drivers=False)
        if not restaurants:
            places = places.withColumn("restaurant_id", F.lit(None).cast("bigint"))
        places = places.select("order_id", "restaurant_id", "order_time")
        return self.table("events").select(
            F.col("event_id").alias("rating_id"), F.col("event_id").alias("order_id"),
            F.col("user_id").alias("driver_id"),
            (F.col("value") / 20).alias("driver_rating"), (F.col("value") / 25).alias("food_rating"),
            (F.col("value") / 30).alias("delivery_rating"), F.col("event_type").alias("rating_type"),
        ).join(places.withColumnRenamed("order_time", "rating_time"), "order_id")

    def bronze_weather(self) -> DataFrame:
        return self.table("events").select(
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            ((cents(F.col("value")) - 6000) / F.lit(100.0)).alias("temperature_celsius"),
            F.pmod(F.col("user_id"), F.lit(100)).cast("int").alias("humidity_percent"),
            F.col("event_type").alias("conditions"),
            (F.col("value") / 4).alias("wind_speed_kmh"))

    def bronze_locations(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("location_id"), F.col("user_id").alias("driver_id"),
            F.col("ts").alias("event_time"))

    # --- silver -------------------------------------------------------------

    def silver_orders(self, drivers: bool = True) -> DataFrame:
        return clean.clean_orders(self.bronze_orders(drivers=drivers), AS_OF)

    def silver_order_items(self) -> DataFrame:
        return clean.clean_order_items(self.bronze_order_items(), AS_OF)

    def silver_ratings(self, restaurants: bool = True) -> DataFrame:
        return clean.clean_ratings(self.bronze_ratings(restaurants), AS_OF)

    def silver_restaurants(self) -> DataFrame:
        return clean.clean_restaurants(self.bronze_restaurants(), AS_OF)

    def silver_drivers(self) -> DataFrame:
        return clean.clean_drivers(self.bronze_drivers(), AS_OF)

    def silver_menu_items(self) -> DataFrame:
        return clean.clean_menu_items(self.bronze_menu_items(), AS_OF)

    def scored_orders(self, drivers: bool = True) -> DataFrame:
        """Orders are processed as they are placed; those under way lack an arrival time."""
        arrived = F.when(F.col("status") != "preparing", F.col("order_time"))
        bronze = self.bronze_orders(drivers=drivers).withColumn("arrival_time", arrived)
        return clean.score_orders(bronze, AS_OF).withColumn("processing_timestamp", F.col("order_time"))

    # --- gold ---------------------------------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.dim_date(self.spark, *CALENDAR)

    def dim_restaurants(self) -> DataFrame:
        return dims.first_load(self.silver_restaurants(), dims.RESTAURANTS, FIRST_LOAD)

    def dim_drivers(self) -> DataFrame:
        return dims.first_load(self.silver_drivers(), dims.DRIVERS, FIRST_LOAD)

    def dim_menu_items(self) -> DataFrame:
        return dims.dim_menu_items(self.silver_menu_items())

    def fact_orders(self, drivers: bool = True, restaurants: bool = True, dates: bool = True) -> DataFrame:
        return facts.fact_orders(
            self.silver_orders(drivers=drivers),
            self.dim_drivers() if drivers else None,
            self.dim_restaurants() if restaurants else None,
            self.calendar if dates else None)

    def fact_ratings(self, orders: bool = True, drivers: bool = True, restaurants: bool = True,
                     dates: bool = True) -> DataFrame:
        return facts.fact_ratings(
            self.silver_ratings(restaurants),
            self.fact_orders(drivers=False, restaurants=False, dates=False) if orders else None,
            self.dim_drivers() if drivers else None,
            self.dim_restaurants() if restaurants else None,
            self.calendar if dates else None)

    def business_summary(self, period: str = "daily") -> DataFrame:
        return facts.fact_business_summary(
            self.fact_orders(drivers=False, restaurants=False),
            self.fact_ratings(orders=False, drivers=False, restaurants=False),
            self.dim_drivers(), self.dim_restaurants(), self.calendar, AS_OF, period)

    # --- history ------------------------------------------------------------

    def earlier_restaurants(self) -> DataFrame:
        """The first snapshot: active restaurants only, the rest appear later."""
        return dims.first_load(self.silver_restaurants().filter("is_active"), dims.RESTAURANTS, FIRST_LOAD)

    def later_restaurants(self) -> DataFrame:
        """The second snapshot: renamed in one part of the world, an address gained in another."""
        region = self._cuisine_regions()
        asian, european = F.col("r_name") == "ASIA", F.col("r_name") == "EUROPE"
        changed = self.silver_restaurants().join(region, "cuisine_type").withColumns({
            "restaurant_name": F.when(asian, F.concat("restaurant_name", F.lit(" II")))
            .otherwise(F.col("restaurant_name")),
            "address": F.when(european, F.concat_ws(" ", F.lit("Unit"), "restaurant_id")),
        })
        return changed.drop("r_name")

    def _cuisine_regions(self) -> DataFrame:
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.table("nation").join(region, "n_regionkey").select(
            F.col("n_name").alias("cuisine_type"), "r_name")

    def earlier_drivers(self) -> DataFrame:
        return dims.first_load(self.silver_drivers().filter("is_active"), dims.DRIVERS, FIRST_LOAD)

    def later_drivers(self) -> DataFrame:
        """The second snapshot: one segment changed vehicle, one lost the record of it."""
        vehicle = (F.when(F.col("vehicle_type") == "MACHINERY", F.lit("VAN"))
                   .when(F.col("vehicle_type") == "BUILDING", F.lit(None))
                   .otherwise(F.col("vehicle_type")))
        return self.silver_drivers().withColumn("vehicle_type", vehicle)
