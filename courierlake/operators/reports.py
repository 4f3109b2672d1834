"""Report queries over bronze and gold frames. Each returns a DataFrame; nothing is collected.

Reports that join facts to a dimension sum the facts per surrogate key first, so
a hot restaurant or driver is one row by the time it meets the join. Every order
ends in a unique column: ties come out the same way each time, and a range sort
can split a value that many rows share.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.operators.dims import current

DELIVERED = "delivered"


def delivered(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == DELIVERED)


def top_k(df: DataFrame, measure: str, k: int, *tiebreak: str) -> DataFrame:
    """The k rows highest in `measure`; each task hands on at most k rows."""
    return df.orderBy(F.desc(measure), *tiebreak).limit(k)


def _total(name: str) -> Column:
    return X.sum_exact(F.col(name))


# --- counts across layers -------------------------------------------------

def layer_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """One row per (layer, table) with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        for (layer, table), df in tables.items()
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


def metric_rows(fact_orders: DataFrame) -> DataFrame:
    """Order count and revenue as rows, from one pass over the facts."""
    totals = fact_orders.agg(
        F.count(F.lit(1)).cast("double").alias("orders"), X.money(_total("total_amount")).alias("revenue"))
    return totals.select(F.inline(F.array(
        F.struct(F.lit("Orders").alias("metric"), F.col("orders").alias("value")),
        F.struct(F.lit("Revenue").alias("metric"), F.col("revenue").alias("value")),
    )))


LEVELS = ("status and day", "status", "day", "all")  # by grouping_id of (status, order_date)


def order_totals(fact_orders: DataFrame) -> DataFrame:
    """Orders, revenue, tips and cancellations per status and day, per status, per day and overall, one row a metric.

    One scan and one shuffle serve all levels (GROUPING SETS), and the metrics become rows after they are summed.
    """
    metrics = {
        "orders": F.count(F.lit(1)).cast("double"), "revenue": X.money(_total("total_amount")),
        "tips": X.money(_total("tip_amount")), "cancelled": F.count_if("cancelled").cast("double")}
    dated = fact_orders.withColumn("order_date", F.to_date("order_time"))
    totals = dated.groupingSets([["status", "order_date"], ["status"], ["order_date"], []], "status", "order_date").agg(
        F.grouping_id().alias("level"), *(c.alias(name) for name, c in metrics.items()))
    level = F.get(F.array(*(F.lit(n) for n in LEVELS)), F.col("level").cast("int"))
    return totals.withColumn("level", level).unpivot(
        ["level", "status", "order_date"], list(metrics), "metric", "value")


# --- orders ----------------------------------------------------------------

def order_detail(fact_orders: DataFrame, restaurants: DataFrame, drivers: DataFrame) -> DataFrame:
    """All orders with the names of their restaurant and driver, oldest first."""
    r = current(restaurants).select("restaurant_key", "restaurant_name")
    d = current(drivers).select("driver_key", F.col("name").alias("driver_name"))
    return (
        fact_orders.join(r, "restaurant_key", "left").join(d, "driver_key", "left")
        .select("order_id", "status", "order_time", "delivery_time", "total_amount", "tip_amount",
                "restaurant_name", "driver_name",
                S.display_minutes(F.col("delivery_minutes")).alias("delivery_minutes"), "cancelled")
        .orderBy("order_time", "order_id")
    )


def status_breakdown(fact_orders: DataFrame, digits: int = 2) -> DataFrame:
    """Count and percent per status, against one scalar total."""
    total = fact_orders.agg(F.count(F.lit(1))).scalar()
    return (
        fact_orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"))
        # a column of its own: the percentage names it more than once
        .withColumn("total", total)
        .withColumn("percentage", X.percent(F.col("order_count"), F.col("total"), digits))
        .drop("total").orderBy(F.desc("order_count"), "status")
    )


def status_share(orders: DataFrame, digits: int = 1) -> DataFrame:
    """Count and percent per status, against a window total over the handful of statuses."""
    total = F.sum("order_count").over(Window.partitionBy(F.lit(1)))
    return (
        orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"))
        .withColumn("percentage", X.percent(F.col("order_count"), total, digits))
        .orderBy(F.desc("order_count"), "status")
    )


def orders_by_restaurant(fact_orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    per_key = fact_orders.groupBy("restaurant_key").agg(F.count(F.lit(1)).alias("n"))
    named = per_key.join(current(restaurants).select("restaurant_key", "restaurant_name"), "restaurant_key")
    return (named.groupBy("restaurant_name").agg(F.sum("n").alias("order_count"))
            .orderBy(F.desc("order_count"), "restaurant_name"))


def orders_by_date(fact_orders: DataFrame) -> DataFrame:
    return (fact_orders.groupBy(F.to_date("order_time").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("daily_orders")).orderBy("order_date"))


def peak_hours(orders: DataFrame, ts: str = "order_time") -> DataFrame:
    return (orders.groupBy(F.hour(ts).alias("hour"))
            .agg(F.count(F.lit(1)).alias("order_count")).orderBy("hour"))


def daily_trends(fact_orders: DataFrame, calendar: DataFrame, days: int = 7) -> DataFrame:
    """The newest calendar days that had orders."""
    per_day = (fact_orders.filter(F.col("date_key").isNotNull()).groupBy("date_key")
               .agg(F.count(F.lit(1)).alias("daily_orders"),
                    X.money(_total("total_amount")).alias("daily_revenue")))
    dated = per_day.join(calendar.select("date_key", F.col("full_date").alias("order_date")), "date_key")
    return (dated.select("order_date", "daily_orders", "daily_revenue")
            .orderBy(F.desc("order_date")).limit(days))


# --- revenue and customers --------------------------------------------------

def revenue_stats(fact_orders: DataFrame) -> DataFrame:
    amount, tip = F.col("total_amount"), F.col("tip_amount")
    return delivered(fact_orders).agg(
        X.sum_money(amount).alias("total_revenue"),
        X.mean_money(amount).alias("avg_order_value"),
        F.round(F.min(amount), 2).alias("min_order"),
        F.round(F.max(amount), 2).alias("max_order"),
        X.sum_money(tip).alias("total_tips"),
        X.mean_money(tip).alias("avg_tip"),
    )


def revenue_summary(fact_orders: DataFrame) -> DataFrame:
    return delivered(fact_orders).agg(
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
        X.mean_money(F.col("total_amount")).alias("avg_order_value"),
        F.count(F.lit(1)).alias("delivered_orders"),
        X.sum_money(F.col("tip_amount")).alias("total_tips"),
    )


def core_metrics(orders: DataFrame) -> DataFrame:
    return delivered(orders).agg(
        X.sum_money(F.col("total_amount")).alias("total_revenue"),
        X.mean_money(F.col("total_amount")).alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("restaurant_id").alias("active_restaurants"),
    )


def customer_value(orders: DataFrame) -> DataFrame:
    """Orders and spending of the average customer; rows without a customer count as one of them
    in both means, but not among the customers."""
    per_customer = delivered(orders).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), _total("total_amount").alias("spent"))
    return per_customer.agg(
        F.count("customer_id").alias("total_customers"),
        X.rounded_ratio(F.sum("order_count"), F.count("order_count"), 1, 1).alias("avg_orders_per_customer"),
        X.rounded_ratio(F.sum("spent"), F.count("spent"), 1, 2).alias("avg_customer_value"),
    )


# --- delivery, restaurants, drivers ----------------------------------------

def delivery_stats(orders: DataFrame, on_time_minutes: int = 30) -> DataFrame:
    seconds = S.seconds_between(F.col("delivery_time"), F.col("order_time"))
    done = delivered(orders).filter(F.col("delivery_time").isNotNull()).withColumn("seconds", seconds)
    on_time = F.count_if(F.col("seconds") <= on_time_minutes * 60)
    return done.agg(
        X.rounded_ratio(F.sum("seconds"), F.count("seconds"), 60, 1).alias("avg_delivery_time"),
        X.percent(on_time, F.count(F.lit(1)), 1).alias("on_time_percentage"),
        F.count_distinct("driver_id").alias("active_drivers"),
    )


def cuisine_performance(orders: DataFrame, restaurants: DataFrame, ratings: DataFrame) -> DataFrame:
    """Delivered orders, revenue and mean food rating per cuisine, over bronze frames."""
    sales = (delivered(orders).groupBy("restaurant_id")
             .agg(F.count("order_id").alias("n"), _total("total_amount").alias("revenue")))
    marks = (ratings.groupBy("restaurant_id")
             .agg(F.sum(X.tenths(F.col("food_rating"))).alias("marks"), F.count("food_rating").alias("rated")))
    per_restaurant = (restaurants.select("restaurant_id", "cuisine_type")
                      .join(sales, "restaurant_id").join(marks, "restaurant_id", "left"))
    return per_restaurant.groupBy("cuisine_type").agg(
        F.sum("n").alias("total_orders"),
        X.money(F.sum("revenue")).alias("total_revenue"),
        X.rounded_ratio(F.sum("marks"), F.sum("rated"), 10, 2).alias("avg_rating"),
    ).orderBy(F.desc("total_revenue"), "cuisine_type")


def top_restaurants(fact_orders: DataFrame, restaurants: DataFrame, k: int = 10) -> DataFrame:
    per_key = delivered(fact_orders).groupBy("restaurant_key").agg(
        F.count("order_id").alias("n"), _total("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"))
    named = per_key.join(
        current(restaurants).select("restaurant_key", "restaurant_name", "cuisine_type"), "restaurant_key")
    ranked = named.groupBy("restaurant_name", "cuisine_type").agg(
        F.sum("n").alias("total_orders"),
        X.money(F.sum("revenue")).alias("total_revenue"),
        X.rounded_ratio(F.sum("revenue"), F.sum("priced"), 1, 2).alias("avg_order_value"),
    )
    return top_k(ranked, "total_revenue", k, "restaurant_name", "cuisine_type")


def _order_marks(fact_ratings: DataFrame, mark: str) -> DataFrame:
    """One row per rated order, so that joining ratings cannot count an order twice."""
    return fact_ratings.groupBy("order_id").agg(
        F.sum(X.tenths(F.col(mark))).alias("marks"), F.count(mark).alias("rated"))


def top_restaurants_rated(fact_orders: DataFrame, fact_ratings: DataFrame, restaurants: DataFrame,
                          k: int = 5) -> DataFrame:
    done = delivered(fact_orders).select("order_id", "restaurant_key", "total_amount")
    per_key = (done.join(_order_marks(fact_ratings, "food_rating"), "order_id", "left")
               .groupBy("restaurant_key")
               .agg(F.count(F.lit(1)).alias("n"), _total("total_amount").alias("revenue"),
                    F.sum("marks").alias("marks"), F.sum("rated").alias("rated")))
    named = per_key.join(current(restaurants).select("restaurant_key", "restaurant_name"), "restaurant_key")
    ranked = named.groupBy("restaurant_name").agg(
        F.sum("n").alias("order_count"),
        X.money(F.sum("revenue")).alias("revenue"),
        X.rounded_ratio(F.sum("marks"), F.sum("rated"), 10, 2).alias("avg_rating"),
    )
    return top_k(ranked, "revenue", k, "restaurant_name")


def top_drivers(fact_orders: DataFrame, fact_ratings: DataFrame, drivers: DataFrame, k: int = 5) -> DataFrame:
    done = (delivered(fact_orders).filter(F.col("driver_key").isNotNull())
            .select("order_id", "driver_key", "delivery_minutes"))
    per_key = (done.join(_order_marks(fact_ratings, "driver_rating"), "order_id", "left")
               .groupBy("driver_key")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.sum(X.tenths(F.col("delivery_minutes"))).alias("minutes"),
                    F.count("delivery_minutes").alias("timed"),
                    F.sum("marks").alias("marks"), F.sum("rated").alias("rated")))
    named = per_key.join(current(drivers).select("driver_key", F.col("name").alias("driver_name")), "driver_key")
    ranked = named.groupBy("driver_name").agg(
        F.sum("n").alias("deliveries"),
        X.rounded_ratio(F.sum("minutes"), F.sum("timed"), 10, 1).alias("avg_delivery_time"),
        X.rounded_ratio(F.sum("marks"), F.sum("rated"), 10, 2).alias("avg_rating"),
    )
    return top_k(ranked, "deliveries", k, "driver_name")


def top_rated(fact_ratings: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Restaurants by mean food rating, best first."""
    per_key = fact_ratings.groupBy("restaurant_key").agg(
        F.sum(X.tenths(F.col("food_rating"))).alias("marks"), F.count("food_rating").alias("rated"),
        F.count(F.lit(1)).alias("n"))
    named = per_key.join(current(restaurants).select("restaurant_key", "restaurant_name"), "restaurant_key")
    return (named.groupBy("restaurant_name")
            .agg((F.sum("marks") / (F.lit(10.0) * F.sum("rated"))).alias("avg_rating"),
                 F.sum("n").alias("rating_count"))
            .orderBy(F.desc("avg_rating"), "restaurant_name"))


def rating_summary(ratings: DataFrame) -> DataFrame:
    """Mean of each kind of rating and how many there are."""
    return ratings.agg(
        F.lit("overall").alias("rating_type"),
        X.mean_rating(F.col("driver_rating"), 2).alias("avg_driver_rating"),
        X.mean_rating(F.col("food_rating"), 2).alias("avg_food_rating"),
        X.mean_rating(F.col("delivery_rating"), 2).alias("avg_delivery_rating"),
        F.count(F.lit(1)).alias("total_ratings"),
    )


def latest_summary(business_summary: DataFrame, days: int = 5) -> DataFrame:
    return business_summary.orderBy(F.desc("date_key"), "time_period").limit(days)


def bronze_stats(orders: DataFrame, ratings: DataFrame, k: int = 5) -> DataFrame:
    """What a load brought: orders per status, the k busiest restaurants, mean of each rating."""
    def rows(df: DataFrame, statistic: str, item: str, value: str) -> DataFrame:
        return df.select(F.lit(statistic).alias("statistic"), F.col(item).cast("string").alias("item"),
                         F.col(value).cast("double").alias("value"))

    # Both counts roll up one aggregate, whose shuffle Spark reuses: the orders are read once.
    both = orders.groupBy("status", "restaurant_id").agg(F.count(F.lit(1)).alias("n"))
    by_status = both.groupBy("status").agg(F.sum("n").alias("n"))
    # Restaurants are told apart from rows without one after the counting, or the filter would part the two scans.
    busiest = top_k(both.groupBy("restaurant_id").agg(F.sum("n").alias("n")), "n", k + 1, "restaurant_id")
    busiest = top_k(busiest.filter(F.col("restaurant_id").isNotNull()), "n", k, "restaurant_id")
    means = ratings.agg(*[
        X.mean_rating(F.col(c), 2).alias(c) for c in ("driver_rating", "food_rating", "delivery_rating")
    ]).unpivot([], ["driver_rating", "food_rating", "delivery_rating"], "item", "value")
    return (rows(by_status, "orders by status", "status", "n")
            .unionByName(rows(busiest, "busiest restaurants", "restaurant_id", "n"))
            .unionByName(rows(means, "mean rating", "item", "value")))
