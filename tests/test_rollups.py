"""Sketches against exact counts, and content fingerprints of layers."""

from pyspark.sql import functions as F

from courierlake.operators import reconcile, rollups
from courierlake.plans.queries import QUERIES
from courierlake.sources.given import Given


def test_sketches_of_days_give_the_customers_of_any_period(spark, testdata):
    orders = Given(spark, f"{testdata}/sf0.01").silver_orders(drivers=False).select(
        "order_time", "restaurant_id", "customer_id", "total_amount")
    sketches = rollups.customer_sketches(orders)
    for unit in ("YEAR", "MM"):
        got = {r.part: r for r in rollups.distinct_customers(sketches, F.trunc("day", unit).alias("part")).collect()}
        want = orders.groupBy(F.trunc("order_time", unit).alias("part")).agg(
            F.count_distinct("customer_id").alias("n"), F.count("*").alias("orders")).collect()
        assert len(got) == len(want)
        for r in want:
            assert abs(got[r.part].customers - r.n) <= max(1, 4 * rollups.RELATIVE_ERROR * r.n)
            assert got[r.part].orders == r.orders
    whole = rollups.distinct_customers(sketches).first()
    assert abs(whole.customers - orders.select("customer_id").distinct().count()) <= 0.04 * whole.customers


def test_estimates_hold_for_many_customers(spark):
    orders = spark.range(400_000).select(
        (F.col("id") % 300_000).alias("customer_id"), (F.col("id") % 50).alias("restaurant_id"),
        F.expr("timestamp '2024-01-01' + make_dt_interval(cast(id % 365 as int))").alias("order_time"),
        F.lit(1.0).alias("total_amount"))
    got = rollups.distinct_customers(rollups.customer_sketches(orders)).first()
    assert abs(got.customers / 300_000 - 1) < 4 * rollups.RELATIVE_ERROR and got.orders == 400_000


def test_query(spark, small):
    rows = QUERIES["customers_by_month"](spark, small).collect()
    assert len(rows) > 50 and all(r.customers > 0 and r.orders >= 1 for r in rows)


def test_a_changed_amount_with_equal_counts_is_found(spark, small):
    silver = Given(spark, small).silver_orders(drivers=False).select("order_id", "order_time", "status", "total_amount",
                                                                     "tip_amount")
    day, columns = F.to_date("order_time"), reconcile.order_columns()
    one, two, three = (r.order_id for r in silver.orderBy("order_id").limit(3).collect())
    other = silver.filter(F.col("order_id") != three).withColumns({
        "total_amount": F.when(F.col("order_id") == one, F.col("total_amount") + 0.01).otherwise(F.col("total_amount")),
        "order_time": F.when(F.col("order_id") == two, F.col("order_time") + F.expr("INTERVAL 40 DAYS"))
        .otherwise(F.col("order_time"))}).repartition(5)
    extra = silver.filter(F.col("order_id") == one).withColumn("order_id", F.lit(-1).cast("bigint"))
    found = reconcile.differing_rows(silver, other.unionByName(extra), day, day, "order_id", columns).collect()
    assert {(r.order_id, r.side, r.columns) for r in found} == {
        (one, "both", "total_cents"), (two, "both", "placed"), (three, "left only", None), (-1, "right only", None)}
    assert reconcile.differing_rows(silver, silver.repartition(3), day, day, "order_id", columns).isEmpty()
