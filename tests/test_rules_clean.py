"""Cleaning rules on literal rows for what the given tables lack."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.operators import clean, rules
from courierlake.schemas import BRONZE, SILVER_COLUMNS

AS_OF = "2024-03-01 12:00:00"


def at(text):
    return datetime.fromisoformat(text)


def order(**over):
    row = {"order_id": "o", "customer_id": "c", "restaurant_id": "r", "driver_id": "d",
           "order_time": at("2024-02-01 10:00:00"), "status": "delivered",
           "delivery_time": at("2024-02-01 10:40:30"), "total_amount": 20.0,
           "prep_start_time": at("2024-02-01 10:05:00"), "prep_end_time": at("2024-02-01 10:25:00"),
           "tip_amount": 2.0}
    row.update(over)
    return tuple(row[f.name] for f in BRONZE["orders"].fields)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE["orders"])


def cleaned(spark, **over):
    out = clean.clean_orders(orders(spark, order(**over)), AS_OF).collect()
    return out[0] if out else None


def test_order_columns_and_minutes(spark):
    df = clean.clean_orders(orders(spark, order()), AS_OF)
    assert df.columns == SILVER_COLUMNS["orders"]
    row = df.first()
    assert row.delivery_time_minutes == 40.5 and row.prep_time_minutes == 20.0
    assert row.cancelled is False and row.ingest_timestamp == at(AS_OF)


@pytest.mark.parametrize("column", ["order_id", "customer_id", "restaurant_id", "order_time", "status"])
def test_missing_required_value_drops_the_order(spark, column):
    assert cleaned(spark, **{column: None}) is None


def test_missing_driver_is_kept(spark):
    assert cleaned(spark, driver_id=None) is not None


def test_unknown_status_is_dropped(spark):
    assert cleaned(spark, status="lost") is None


def test_future_order_is_clamped_before_delivery_is_compared(spark):
    row = cleaned(spark, order_time=at("2024-04-01 00:00:00"), delivery_time=at("2024-03-15 00:00:00"))
    assert row.order_time == at(AS_OF)
    assert row.delivery_time == at("2024-03-15 00:00:00")
    early = cleaned(spark, order_time=at("2024-04-01 00:00:00"), delivery_time=at("2024-02-01 00:00:00"))
    assert early.delivery_time is None and early.delivery_time_minutes is None


def test_negative_prep_time_is_kept(spark):
    row = cleaned(spark, prep_end_time=at("2024-02-01 10:00:00"))
    assert row.prep_time_minutes == -5.0


def test_money(spark):
    row = cleaned(spark, total_amount=-3.0, tip_amount=1.005)
    assert row.total_amount == 0.0 and row.tip_amount == 1.01
    assert cleaned(spark, tip_amount=None).tip_amount is None


def test_items_need_a_whole_positive_quantity(spark):
    rows = [("a", "o", "i", 2.0, 1.25), ("b", "o", "i", 0.5, 1.0), ("c", "o", "i", 1.0, 0.0),
            ("d", "o", "i", -1.0, 1.0), ("e", "o", None, 1.0, 1.0), ("f", "o", "i", None, 1.0)]
    df = spark.createDataFrame(rows, "order_item_id string, order_id string, item_id string, quantity double, "
                                     "item_price double").withColumn("order_time", F.lit(None).cast("timestamp"))
    out = clean.clean_order_items(df, AS_OF).collect()
    assert [(r.order_item_id, r.quantity, r.extended_price) for r in out] == [("a", 2, 2.5)]


def test_labels_are_trimmed_or_defaulted(spark):
    menu = spark.createDataFrame([("i", "r", " Soup ", None, 3.0, True, None), ("j", "r", "x", None, 1.0, True, " main ")],
                                 BRONZE["menu_items"])
    got = {r.item_id: (r.item_name, r.category) for r in clean.clean_menu_items(menu, AS_OF).collect()}
    assert got == {"i": ("Soup", "Other"), "j": ("x", "main")}
    drivers = spark.createDataFrame([("d", " Ann ", "1", None, 4.0, True)], BRONZE["drivers"])
    row = clean.clean_drivers(drivers, AS_OF).first()
    assert (row.name, row.vehicle_type) == ("Ann", "Unknown")
    places = spark.createDataFrame([("r", " Inn ", None, "a", "p", 4.0, True)], BRONZE["restaurants"])
    row = clean.clean_restaurants(places, AS_OF).first()
    assert (row.restaurant_name, row.cuisine_type) == ("Inn", "Other")


def test_rating_bounds_are_inclusive(spark):
    def rating(i, *marks):
        return (i, "o", "d", "r", *marks, at("2024-02-01 00:00:00"), None)

    df = spark.createDataFrame([rating("low", 1.0, 1.0, 1.0), rating("high", 5.0, 5.0, 5.0),
                                rating("under", 0.99, 3.0, 3.0), rating("over", 3.0, 5.01, 3.0),
                                rating("null", 3.0, 3.0, None)], BRONZE["ratings"])
    out = clean.clean_ratings(df, AS_OF).collect()
    assert sorted(r.rating_id for r in out) == ["high", "low"]
    assert {r.rating_type for r in out} == {"unknown"}


def test_weather(spark):
    df = spark.createDataFrame([("2024-02-01", 20.04, 50, " sunny ", 3.33), ("2024-02-02", 61.0, 50, "x", 1.0),
                                ("no date", 20.0, 50, "x", 1.0), (None, 20.0, 50, "x", 1.0),
                                ("2024-02-03", -50.0, 50, None, 1.0)], BRONZE["weather"])
    out = sorted(clean.clean_weather(df, AS_OF).collect(), key=lambda r: r.date)
    assert [(r.date, r.temperature_celsius, r.conditions) for r in out] == [
        (date(2024, 2, 1), 20.0, "sunny"), (date(2024, 2, 3), -50.0, "Unknown")]


def test_quality_ladder_takes_the_first_fault(spark):
    bronze = orders(spark, order(order_id="good"), order(order_id="customer", customer_id=None, restaurant_id=None),
                    order(order_id="restaurant", restaurant_id=None, total_amount=0.0),
                    order(order_id="amount", total_amount=0.0), order(order_id="late"))
    arrived = F.when(F.col("order_id") != "late", F.col("order_time"))
    out = clean.score_orders(bronze.withColumn("arrival_time", arrived), AS_OF).collect()
    assert {r.order_id: r.data_quality_score for r in out} == {
        "good": 1.0, "customer": 0.2, "restaurant": 0.1, "amount": 0.3, "late": 0.4}


def test_locations(spark):
    df = spark.createDataFrame([("l", "d"), (None, "d"), ("l", None)], "location_id string, driver_id string")
    assert clean.clean_locations(df, AS_OF).count() == 1


def test_kept_and_rejected_rows_make_up_the_input(spark, small):
    from courierlake.sources.given import Given

    bronze = Given(spark, small).bronze_orders(drivers=False)
    good, bad = rules.keep(bronze, rules.order_rules()), rules.rejected(bronze, rules.order_rules())
    assert good.count() + bad.count() == bronze.count() and bad.count() > 0


def test_reasons_name_every_broken_rule(spark):
    bad = rules.rejected(orders(spark, order(customer_id=None, status="lost"), order()), rules.order_rules())
    assert [r.reasons for r in bad.collect()] == [["customer_id is missing", "status is unknown"]]


def test_metrics_and_gate(spark):
    metrics = rules.quality_metrics(orders(spark, order(), order(customer_id=None)), rules.order_rules())
    found = {r.rule: (r.total_rows, r.invalid_rows) for r in metrics.collect()}
    assert found["customer_id is missing"] == (2, 1) and found["any rule"] == (2, 1)
    rules.gate(metrics, 0.5)
    with pytest.raises(rules.QualityGateError, match="customer_id is missing: 1 of 2"):
        rules.gate(metrics, 0.4)


def test_gate_passes_an_empty_table(spark):
    rules.gate(rules.quality_metrics(orders(spark).limit(0), rules.order_rules()), 0.0)


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "item string, k string")
    parent = spark.createDataFrame([("1",)], "k string")
    assert [r.item for r in rules.orphans(child, parent, "k").collect()] == ["b"]
    with pytest.raises(ValueError, match="not unique"):
        rules.assert_unique(child.union(child), "item")


@pytest.mark.parametrize("total, count, unit, digits, want", [
    (5, 2, 1, 0, 3.0), (-5, 2, 1, 0, -3.0), (1, 3, 1, 3, 0.333), (2005, 2, 100, 2, 10.03),
    (-1, 1000, 1, 1, 0.0), (None, 0, 1, 1, None), (90, 1, 60, 1, 1.5)])
def test_rounded_ratio(spark, total, count, unit, digits, want):
    df = spark.createDataFrame([(total, count)], "t bigint, n bigint")
    got = df.select(X.rounded_ratio(F.col("t"), F.col("n"), unit, digits)).first()[0]
    assert got == want and str(got) == str(want)


def test_whole_units(spark):
    values = [(0.0, 0), (0.29, 29), (-0.29, -29), (0.005, 1), (-0.005, -1), (1.005, 100), (19.99, 1999), (None, None),
              (123456789.12, 12345678912)]
    df = spark.createDataFrame(values, "x double, want bigint")
    assert df.filter(~X.cents(F.col("x")).eqNullSafe(F.col("want"))).isEmpty()
    assert dict(df.select(X.cents(F.col("x")).alias("c")).dtypes) == {"c": "bigint"}
    seconds = spark.range(200_000).select(F.col("id"), (F.col("id") / F.lit(60.0)).alias("m"))
    assert seconds.filter(X.whole_seconds(F.col("m")) != F.col("id")).isEmpty()


def test_small_scalars(spark):
    row = spark.range(1).select(
        S.sla_breached(F.lit(45.0)).alias("at"), S.sla_breached(F.lit(45.1)).alias("over"),
        S.sla_breached(F.lit(None).cast("double")).alias("none"),
        S.display_minutes(F.lit(12.9)).alias("shown"),
        S.date_key(F.lit("2024-02-09").cast("date")).alias("key")).first()
    assert (row["at"], row.over, row.none, row.shown, row.key) == (False, True, False, 12, 20240209)


def test_sums_are_rounded_after_the_sum(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"), F.lit(9e18).alias("big"), F.lit(float("nan")).alias("odd"))
    got = df.agg(X.sum_money(F.col("x")).alias("a"), X.mean_money(F.col("x")).alias("b"),
                 X.sum_money(F.col("big")).alias("c"), X.sum_money(F.col("odd")).alias("d")).first()
    assert tuple(got) == (4.0, 0.0, 9e21, None)


def test_a_price_that_rounds_to_nothing_and_a_huge_quantity_are_rejected(spark):
    rows = [("a", "o", "i", 1.0, 0.004), ("b", "o", "i", 1e300, 1.0), ("c", "o", "i", 2.0, 0.005)]
    df = spark.createDataFrame(rows, "order_item_id string, order_id string, item_id string, quantity double, "
                                     "item_price double").withColumn("order_time", F.current_timestamp())
    kept = clean.clean_order_items(df, "2024-01-01 00:00:00").collect()
    assert [(r.order_item_id, r.quantity, r.item_price) for r in kept] == [("c", 2, 0.01)]
