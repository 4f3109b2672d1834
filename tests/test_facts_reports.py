"""Facts and reports on small literal rows: unmatched keys, days outside the calendar, ties."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from courierlake.operators import clean, daily, dims, facts, reports
from courierlake.schemas import BRONZE, GOLD_COLUMNS

AS_OF = "2024-03-01 00:00:00"


def order(i, day, restaurant="r1", driver="d1", amount=10.0, status="delivered", minutes=30):
    placed = datetime(2024, 1, day, 10)
    return (f"o{i}", f"c{i % 2}", restaurant, driver, placed, status, placed.replace(minute=minutes % 60, hour=10 + minutes // 60),
            amount, placed, placed, 1.0)


@pytest.fixture(scope="module")
def star(spark):
    orders = clean.clean_orders(spark.createDataFrame(
        [order(1, 1), order(2, 1, "r2", None, 20.0), order(3, 2, "nowhere", "nobody", 30.0, minutes=60),
         order(4, 20, amount=40.0), order(5, 2, status="cancelled")], BRONZE["orders"]), AS_OF)
    rating = [(f"x{i}", o, "d1", "r1", 4.0, f, 4.0, datetime(2024, 1, 1, 12), "t")
              for i, (o, f) in enumerate([("o1", 3.0), ("o1", 5.0), ("gone", 4.5)])]
    ratings = clean.clean_ratings(spark.createDataFrame(rating, BRONZE["ratings"]), AS_OF)
    restaurants = dims.first_load(clean.clean_restaurants(spark.createDataFrame(
        [(r, f"name {r}", "Any", None, None, None, True) for r in ("r1", "r2")], BRONZE["restaurants"]), AS_OF),
        dims.RESTAURANTS, AS_OF)
    drivers = dims.first_load(clean.clean_drivers(spark.createDataFrame(
        [("d1", "Ann", None, "car", None, False)], BRONZE["drivers"]), AS_OF), dims.DRIVERS, AS_OF)
    calendar = dims.dim_date(spark, "2024-01-01", "2024-01-10")
    fo = facts.fact_orders(orders, drivers, restaurants, calendar)
    fr = facts.fact_ratings(ratings, fo, drivers, restaurants, calendar)
    return {"orders": orders, "ratings": ratings, "restaurants": restaurants, "drivers": drivers,
            "calendar": calendar, "fo": fo, "fr": fr}


def test_unmatched_keys_are_null(star):
    got = {r.order_id: r for r in star["fo"].collect()}
    assert star["fo"].columns == GOLD_COLUMNS["fact_orders"] and len(got) == 5
    assert got["o1"].driver_key is not None and got["o2"].driver_key is None
    assert got["o3"].driver_key is None and got["o3"].restaurant_key is None
    assert got["o4"].date_key is None and got["o1"].date_key == 20240101
    assert got["o3"].sla_breached and not got["o1"].sla_breached


def test_rating_without_order(star):
    assert star["fr"].filter("order_key IS NULL").count() == 1
    assert star["fr"].columns == GOLD_COLUMNS["fact_ratings"]


def test_orphan_line_is_dropped_and_unknown_item_kept(spark, star):
    lines = spark.createDataFrame([("l1", "o1", "i9", 1, 2.0, datetime(2024, 1, 1)),
                                   ("l2", "gone", "i9", 1, 2.0, datetime(2024, 1, 1))], BRONZE["order_items"])
    menu = dims.dim_menu_items(clean.clean_menu_items(spark.createDataFrame([], BRONZE["menu_items"]), AS_OF))
    out = facts.fact_order_items(clean.clean_order_items(lines, AS_OF), star["fo"], menu, star["calendar"]).collect()
    assert [(r.order_id, r.menu_item_key) for r in out] == [("o1", None)]


def test_daily_facts_keep_known_rows_inside_the_calendar(spark, star):
    perf = daily.restaurant_performance(star["orders"], star["ratings"], AS_OF)
    lines = clean.clean_order_items(spark.createDataFrame(
        [("l1", "o1", "i1", 1, 2.0, None), ("l2", "o1", "i2", 1, 2.0, None), ("l3", "o1", "i2", 1, 2.0, None)],
        BRONZE["order_items"]), AS_OF)
    out = facts.fact_restaurant_daily(perf, star["restaurants"], star["calendar"],
                                      facts.items_sold(lines, star["orders"]))
    assert out.columns == GOLD_COLUMNS["fact_restaurant_daily"]
    got = sorted((r.date_key, r.orders_count, r.avg_rating, r.active_menu_items) for r in out.collect())
    assert got == [(20240101, 1, 4.0, 0), (20240101, 1, 4.2, 2), (20240102, 1, 4.0, 0)]
    drv = facts.fact_driver_daily(daily.driver_performance(star["orders"], star["ratings"], AS_OF),
                                  star["drivers"], star["calendar"])
    assert drv.columns == GOLD_COLUMNS["fact_driver_daily"]
    assert sorted((r.date_key, r.orders_completed, r.total_earnings, r.hours_worked) for r in drv.collect()) == [
        (20240101, 1, 1.2, 0.75), (20240102, 1, 1.2, 0.75)]


def test_summary(star):
    out = facts.fact_business_summary(star["fo"], star["fr"], star["drivers"], star["restaurants"], star["calendar"], AS_OF)
    assert out.columns == GOLD_COLUMNS["fact_business_summary"]
    got = {r.date_key: r for r in out.collect()}
    assert sorted(got) == [20240101, 20240102]
    first = got[20240101]
    assert (first.total_orders, first.total_revenue, first.avg_order_value, first.avg_delivery_time) == (2, 30.0, 15.0, 30.0)
    # three ratings: 4 3 4, 4 5 4, 4 4.5 4
    assert first.overall_satisfaction == 4.06 and got[20240102].overall_satisfaction == 4.0
    # current rows count, active or not
    assert (first.active_drivers, first.active_restaurants) == (1, 2)
    assert got[20240102].sla_breach_rate == 0.5
    with pytest.raises(ValueError, match="period"):
        facts.fact_business_summary(star["fo"], star["fr"], star["drivers"], star["restaurants"],
                                    star["calendar"], AS_OF, "weekly")


def test_two_ratings_of_an_order_count_it_once(star):
    out = {r.restaurant_name: r for r in
           reports.top_restaurants_rated(star["fo"], star["fr"], star["restaurants"]).collect()}
    assert out["name r1"].order_count == 2 and out["name r1"].revenue == 50.0 and out["name r1"].avg_rating == 4.0
    assert out["name r2"].avg_rating is None


def test_recent_facts_use_the_unknown_key(star):
    scored = star["orders"].withColumns({"data_quality_score": F.lit(1.0),
                                         "processing_timestamp": F.col("order_time")})
    out = facts.recent_fact_orders(scored, star["drivers"], star["restaurants"], "2024-01-03 00:00:00", "1 DAY")
    got = {r.order_id: (r.restaurant_key, r.driver_key) for r in out.collect()}
    assert set(got) == {"o3", "o4", "o5"} and got["o3"] == (-1, -1)
    activity = {r.customer_id: r.recent_order_count
                for r in facts.customer_activity(scored, "2024-01-03 00:00:00").collect()}
    assert activity == {"c1": 2, "c0": 1}


def test_reports_on_no_rows(star):
    none = star["fo"].limit(0)
    assert reports.revenue_stats(none).first().total_revenue is None
    assert reports.status_breakdown(none).count() == 0
    assert reports.metric_rows(none).count() == 2


def test_top_k_ties_are_settled(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n int")
    assert [r.k for r in reports.top_k(df, "n", 2, "k").collect()] == ["c", "a"]


def test_duplicate_current_row_is_caught(star):
    from courierlake.operators.rules import assert_unique

    twice = star["drivers"].union(star["drivers"])
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(dims.current(twice), "driver_id")


def test_reports_of_many_totals_read_their_input_once(spark, small):
    from courierlake.sources.given import Given

    g = Given(spark, small)
    orders = spark.read.parquet(f"{small}/orders.parquet").selectExpr(
        "o_orderkey AS order_id", "o_orderstatus AS status", "o_custkey AS restaurant_id")
    stats = reports.bronze_stats(orders, g.silver_ratings(restaurants=False))
    assert stats.count() > 0
    rows = stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert len(rows) > 5 and "ReusedExchange" in plan
    totals = reports.order_totals(g.fact_orders(drivers=False, restaurants=False, dates=False))
    assert totals._jdf.queryExecution().executedPlan().toString().count("orders.parquet") == 1


def test_busiest_restaurants_leave_out_rows_without_one(spark):
    orders = spark.createDataFrame(
        [(1, "a", None)] * 9 + [(1, "a", 1)] * 3 + [(1, "b", 2)] * 2 + [(1, None, 3)] * 2, "order_id int, status string, restaurant_id int")
    marks = spark.createDataFrame([], "driver_rating double, food_rating double, delivery_rating double")
    got = {(r.statistic, r.item): r.value for r in reports.bronze_stats(orders, marks, k=2).collect()}
    assert {i: v for (s, i), v in got.items() if s == "busiest restaurants"} == {"1": 3, "2": 2}
    assert {i: v for (s, i), v in got.items() if s == "orders by status"} == {"a": 12, "b": 2, None: 2}
