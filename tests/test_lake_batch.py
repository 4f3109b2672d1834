"""Table versions, day rewrites, the whole pipeline, and late data against a full rebuild."""

import shutil

import pytest
from pyspark.sql import functions as F

from courierlake.operators import late
from courierlake.operators.rules import QualityGateError
from courierlake.plans import batch
from courierlake.schemas import BRONZE, GOLD_COLUMNS
from courierlake.sources import synth
from courierlake.sources.lake import Lake

AS_OF = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    synth.synth_lake(lake, 600, 7, AS_OF, days=4)
    batch.run_batch(lake, AS_OF)
    return lake


def rows(df, *drop):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted(map(str, df.select(*cols).collect()))


def copy_of(lake, folder):
    shutil.copytree(lake.root, folder)
    return Lake(lake.spark, str(folder))


def test_replace_makes_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([("a",)], "k string")
    assert not lake.exists("gold", "t") and lake.safe_count("gold", "t") == 0
    assert lake.replace(df, "gold", "t") == 1
    # a table may be rebuilt from itself
    assert lake.replace(lake.read("gold", "t").union(df), "gold", "t") == 2
    assert lake.version("gold", "t") == 2
    assert lake.read("gold", "t").count() == 2 and lake.read("gold", "t", version=1).count() == 1
    with pytest.raises(ValueError, match="no table"):
        lake.read("gold", "missing")


def test_views_follow_the_table_and_old_versions_go(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.ensure_bronze()
    made = synth.synth_orders(spark, 20, 1, AS_OF).orders
    lake.register_views()
    assert spark.sql("SELECT * FROM bronze.bronze_orders").count() == 0
    for n in (1, 2, 3):
        lake.replace(made.filter(f"crc32(order_id) % 4 < {n}"), "bronze", "bronze_orders")
    assert spark.sql("SELECT * FROM bronze.bronze_orders").count() == lake.safe_count("bronze", "bronze_orders") > 0
    assert lake.remove_old_versions("bronze", "bronze_orders", keep=2) == [1, 2]
    assert lake.remove_old_versions("bronze", "bronze_orders", keep=2) == []


def test_days_are_emptied_and_compacted(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    made = synth.synth_orders(spark, 40, 1, AS_OF, days=2).orders
    lake.ensure("bronze", "bronze_orders", BRONZE["orders"])
    for n in range(3):
        lake.append_batch(made, "bronze", "bronze_orders", n)
    days = sorted(r[0] for r in lake.read("bronze", "bronze_orders").select("order_date").distinct().collect())
    before = rows(lake.read("bronze", "bronze_orders"), "batch_id")
    files = lambda: lake._files(f"{lake.path('bronze', 'bronze_orders')}/v=1/order_date={days[0]}")
    assert len(files()) >= 3
    lake.compact_days("bronze", "bronze_orders", days[:1])
    assert rows(lake.read("bronze", "bronze_orders"), "batch_id") == before and len(files()) == 1
    none = lake.read("bronze", "bronze_orders").limit(0).drop("order_date")
    lake.replace_days(none, "bronze", "bronze_orders", days[:1])
    left = lake.read("bronze", "bronze_orders")
    assert left.filter(F.col("order_date") == days[0]).isEmpty() and not left.isEmpty()


def test_empty_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.ensure("bronze", "bronze_orders", BRONZE["orders"])
    lake.ensure("bronze", "bronze_orders", BRONZE["orders"])
    assert lake.version("bronze", "bronze_orders") == 1 and lake.read("bronze", "bronze_orders").count() == 0


def test_append_checks_columns(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    lake.replace(df, "gold", "t")
    lake.append(df, "gold", "t")
    assert lake.safe_count("gold", "t") == 2
    with pytest.raises(ValueError, match="has columns"):
        lake.append(df.select("k"), "gold", "t")


def test_batch_written_twice_counts_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    made = synth.synth_orders(spark, 50, 1, AS_OF)
    lake.ensure("bronze", "bronze_orders", BRONZE["orders"])
    for batch_id in (0, 1, 1):
        lake.append_batch(made.orders, "bronze", "bronze_orders", batch_id)
    assert lake.safe_count("bronze", "bronze_orders") == 100


def test_pipeline_fills_every_layer(lake):
    counts = {r.table_name: r.row_count for r in batch.reconcile(lake, ready_at=500).collect()}
    assert counts["bronze_orders"] == counts["silver_orders"] == counts["fact_orders"] == 600
    assert counts["fact_order_items"] == counts["bronze_order_items"] > 600
    for table, columns in GOLD_COLUMNS.items():
        if table != "customer_activity":
            assert lake.read("gold", table).columns[:len(columns)] == columns


def test_second_run_on_the_same_input_changes_no_dimension(lake):
    before = rows(lake.read("gold", "dim_drivers"))
    batch.run_gold(lake, "2024-03-02 00:00:00")
    assert rows(lake.read("gold", "dim_drivers")) == before
    batch.run_gold(lake, AS_OF)


def test_tables_are_readable_in_sql(lake):
    lake.register_views()
    spark = lake.spark
    n = spark.sql("""
        SELECT count(*) AS n FROM gold.fact_orders fo
        JOIN gold.dim_restaurants dr ON fo.restaurant_key = dr.restaurant_key AND dr.is_current = true""").first().n
    assert n == 600
    assert spark.sql("SHOW TABLES IN silver").count() >= 9
    assert spark.sql("DESCRIBE bronze.bronze_orders").count() >= 11
    described = lake.describe().filter("table_name = 'fact_orders'").collect()
    assert ("order_key", "string") in {(r.column, r.type) for r in described}


def test_gate_stops_the_pipeline(lake):
    bad = lake.read("silver", "silver_ratings").limit(3).withColumn("food_rating", F.lit(9.0)).drop("rating_date")
    other = Lake(lake.spark, lake.root + "_gate")
    for t in ("orders", "order_items"):
        other.replace(lake.read("silver", f"silver_{t}").drop("order_date"), "silver", f"silver_{t}")
    other.replace(bad, "silver", "silver_ratings")
    with pytest.raises(QualityGateError, match="food_rating"):
        batch.check_silver(other)


def test_day_rewrite_leaves_other_days(lake):
    other = Lake(lake.spark, lake.root + "_days")
    silver = lake.read("silver", "silver_orders").drop("order_date")
    other.replace(silver, "silver", "silver_orders")
    day = silver.select(F.min(F.to_date("order_time"))).first()[0]
    one = silver.filter(F.to_date("order_time") == day).withColumn("status", F.lit("placed"))
    n = other.replace_days(one, "silver", "silver_orders")
    now = other.read("silver", "silver_orders")
    assert now.count() == 600 and now.filter("status = 'placed'").count() == n > 0


@pytest.fixture()
def with_late_rows(lake, tmp_path):
    """A copy of the bronze layer that gains late orders, their lines and nothing else."""
    spark = lake.spark

    def make(name):
        copy = Lake(spark, str(tmp_path / name))
        for t in BRONZE:
            df = lake.read("bronze", f"bronze_{t}")
            copy.replace(df.drop("order_date", "rating_date", "batch_id"), "bronze", f"bronze_{t}")
        return copy

    return make


def test_reprocess_equals_a_full_rebuild(lake, with_late_rows):
    more = synth.synth_orders(lake.spark, 12, 99, AS_OF, days=4)
    renamed = F.concat(F.lit("late_"), F.col("order_id"))
    late_orders = more.orders.withColumn("order_id", renamed).filter(F.day("order_time") % 2 == 0)
    late_items = (more.order_items.withColumn("order_id", renamed)
                  .withColumn("order_item_id", F.concat(F.lit("late_"), "order_item_id"))
                  .join(late_orders.select("order_id"), "order_id", "left_semi"))

    part = with_late_rows("part")
    # one rated order was missing at first: its rating must find it later
    orphan = part.read("bronze", "bronze_ratings").orderBy("rating_id").first().order_id
    columns = BRONZE["orders"].names
    held_back = part.read("bronze", "bronze_orders").filter(F.col("order_id") == orphan).select(*columns)
    held_back = lake.spark.createDataFrame(held_back.collect(), held_back.schema)
    rest = part.read("bronze", "bronze_orders").filter(F.col("order_id") != orphan).select(*columns)
    part.replace(rest, "bronze", "bronze_orders")
    batch.run_batch(part, AS_OF)
    assert part.read("gold", "fact_ratings").filter("order_key IS NULL").count() == 1

    arrived = late_orders.select(*columns).union(held_back.select(*columns))
    part.append(arrived, "bronze", "bronze_orders")
    part.append(late_items.select(*BRONZE["order_items"].names), "bronze", "bronze_order_items")
    days = batch.reprocess(part, arrived, AS_OF)
    assert 0 < len(days) <= arrived.count()

    whole = with_late_rows("whole")
    whole.append(late_orders.select(*columns), "bronze", "bronze_orders")
    whole.append(late_items.select(*BRONZE["order_items"].names), "bronze", "bronze_order_items")
    batch.run_batch(whole, AS_OF)
    for layer, table in whole.tables():
        assert rows(part.read(layer, table), "batch_id") == rows(whole.read(layer, table), "batch_id"), table


def test_reprocess_of_nothing(lake):
    assert batch.reprocess(lake, lake.read("bronze", "bronze_orders").limit(0), AS_OF) == []


def test_confirmation_cycle(lake, tmp_path):
    """Orders under way are confirmed at the end of the day and their days rebuilt."""
    spark = lake.spark
    other = copy_of(lake, tmp_path / "lake")
    waiting = F.when(F.col("order_id") < "order_000010", F.lit("ready")).otherwise(F.col("status"))
    bronze = spark.createDataFrame(lake.read("bronze", "bronze_orders").drop("order_date").collect(),
                                   lake.read("bronze", "bronze_orders").drop("order_date").schema)
    other.replace(bronze.withColumn("status", waiting), "bronze", "bronze_orders")
    batch.reprocess(other, bronze, AS_OF)
    assert other.read("gold", "fact_orders").filter("status = 'ready'").count() == 9
    assert late.incomplete_orders(other.read("bronze", "bronze_orders")).count() == 9
    days = batch.confirm_deliveries(other, AS_OF)
    assert days and other.safe_count("bronze", "bronze_orders") == 600
    facts = other.read("gold", "fact_orders")
    assert facts.filter("status = 'ready'").count() == 0 and facts.count() == 600
    assert facts.filter(F.col("delivery_time") == F.lit(AS_OF).cast("timestamp")).count() == 9
    assert batch.confirm_deliveries(other, AS_OF) == []


def test_late_arrivals_are_caught_up(lake, tmp_path):
    spark = lake.spark
    other = copy_of(lake, tmp_path / "lake")
    more = synth.synth_orders(spark, 6, 3, AS_OF).orders.withColumns({
        "order_id": F.concat(F.lit("late_"), "order_id"),
        "arrival_time": F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 5 MINUTES"),
        "order_time": F.lit("2024-02-28 20:00:00").cast("timestamp")})
    other.append_batch(more, "bronze", "bronze_orders", 0)
    # an hour later nothing is lost, and a second run finds nothing new
    assert [str(d) for d in batch.catch_up(other, "2024-03-01 01:00:00")] == ["2024-02-28"]
    assert batch.catch_up(other, "2024-03-01 01:15:00") == []
    assert other.read("gold", "fact_orders").filter("order_id LIKE 'late%'").count() == 6
    impact = other.read("gold", "late_impact").collect()
    assert [(str(r.order_date), r.orders_delta) for r in impact] == [("2024-02-28", 6.0)]
    critical = more.withColumns({"order_id": F.concat(F.lit("very_"), "order_id"), "order_time": F.lit(
        "2024-02-26 08:00:00").cast("timestamp"), "arrival_time": F.lit("2024-03-01 02:00:00").cast("timestamp")})
    other.append_batch(critical, "bronze", "bronze_orders", 1)
    assert [str(d) for d in batch.catch_up(other, "2024-03-01 03:00:00")] == ["2024-02-26"]
    assert other.read("gold", "fact_orders").filter("order_id LIKE 'very%'").count() == 6
    assert other.read("bronze", "lateness_runs").filter("lateness = 'Critical'").agg(F.sum("records")).first()[0] == 6


def without_stamps(df):
    return rows(df, "ingest_timestamp", "updated_at", "arrival_time", "batch_id")


def test_rebuild_at_a_later_time_equals_a_full_run(lake, with_late_rows):
    """Orders and lines dated ahead, a state delivered again, a day whose orders all become invalid."""
    spark, columns = lake.spark, BRONZE["orders"].names
    later = "2024-03-04 00:00:00"
    ahead = synth.synth_orders(spark, 5, 42, AS_OF)
    stamp = F.lit("2024-03-03 10:00:00").cast("timestamp")
    orders = ahead.orders.withColumns({"order_id": F.concat(F.lit("ahead_"), "order_id"), "order_time": stamp})
    items = ahead.order_items.withColumns({
        "order_id": F.concat(F.lit("ahead_"), "order_id"), "order_item_id": F.concat(F.lit("ahead_"), "order_item_id"),
        "order_time": stamp})

    part = with_late_rows("part2")
    part.append(orders.select(*columns), "bronze", "bronze_orders")
    part.append(items.select(*BRONZE["order_items"].names), "bronze", "bronze_order_items")
    batch.run_batch(part, AS_OF)
    assert part.read("silver", "silver_orders").filter("order_id LIKE 'ahead%' AND order_date = '2024-03-01'").count() == 5

    bronze = part.read("bronze", "bronze_orders")
    day = bronze.filter("order_date < '2024-03-01'").agg(F.min("order_date")).first()[0]
    again = bronze.filter(F.col("order_date") == day).select(*columns).withColumn("status", F.lit("zzz"))
    again = spark.createDataFrame(again.collect(), again.schema)
    part.append_batch(again.withColumn("arrival_time", F.lit("2024-03-02 00:00:00").cast("timestamp")),
                      "bronze", "bronze_orders", 1)
    days = batch.catch_up(part, later, max_invalid_rate=1.0)
    assert day in days and "2024-03-03" in {str(d) for d in days}
    assert part.read("gold", "fact_orders").filter(F.col("order_date") == day).count() == 0

    whole = Lake(spark, part.root + "_whole")
    for t in BRONZE:
        whole.replace(part.read("bronze", f"bronze_{t}").drop("order_date", "rating_date"), "bronze", f"bronze_{t}")
    batch.run_batch(whole, later, max_invalid_rate=1.0)
    for layer, table in whole.tables():
        if table not in ("dim_date", "dim_drivers", "dim_restaurants", "dim_menu_items"):
            assert without_stamps(part.read(layer, table)) == without_stamps(whole.read(layer, table)), table


def test_an_order_delivered_twice_counts_once(lake, with_late_rows):
    part = with_late_rows("twice")
    columns = BRONZE["orders"].names
    first = part.read("bronze", "bronze_orders").select(*columns)
    first = lake.spark.createDataFrame(first.collect(), first.schema)
    stamp = F.lit(AS_OF).cast("timestamp")
    part.append_batch(first.withColumns({"status": F.lit("cancelled"), "arrival_time": stamp}), "bronze", "bronze_orders", 3)
    batch.run_batch(part, AS_OF)
    facts = part.read("gold", "fact_orders")
    assert facts.count() == 600 == facts.filter("status = 'cancelled'").count()
    assert part.read("gold", "fact_order_items").count() == lake.read("gold", "fact_order_items").count()


def test_bad_bronze_stops_before_silver_changes(lake, with_late_rows):
    part = with_late_rows("bad")
    batch.run_batch(part, AS_OF)
    version = part.version("silver", "silver_orders")
    columns = BRONZE["orders"].names
    broken = part.read("bronze", "bronze_orders").select(*columns).withColumns(
        {"order_id": F.concat(F.lit("bad_"), "order_id"), "status": F.lit("zzz")})
    part.append(broken, "bronze", "bronze_orders")
    with pytest.raises(QualityGateError, match="status is unknown"):
        batch.run_batch(part, "2024-03-02 00:00:00")
    assert part.version("silver", "silver_orders") == version
    assert part.read("bronze", "rejected_orders").count() == 600
    assert part.read("bronze", "quality_metrics").filter("rule = 'any rule' AND table_name = 'orders'").count() == 2


def test_catch_up_takes_in_whatever_lags(lake, with_late_rows):
    """An arrival before the newest one, one at the same time, a late line and a late rating: as a full run."""
    spark = lake.spark
    part = with_late_rows("lagging")
    batch.run_batch(part, AS_OF)
    stamp = F.lit("2024-02-29 10:00:00").cast("timestamp")

    def fixed(df):
        return spark.createDataFrame(df.collect(), df.schema)

    def renamed(df, head, *keys):
        return fixed(df.withColumns({k: F.concat(F.lit(head), F.col(k)) for k in keys}))

    orders = lake.read("bronze", "bronze_orders").select(*BRONZE["orders"].names).orderBy("order_id")
    items = lake.read("bronze", "bronze_order_items").select(*BRONZE["order_items"].names).orderBy("order_item_id")
    ratings = lake.read("bronze", "bronze_ratings").select(*BRONZE["ratings"].names).orderBy("rating_id")

    def append(df, table, n, minutes=None):
        if minutes is not None:
            df = df.withColumn("arrival_time", stamp - F.expr(f"INTERVAL {minutes} MINUTES"))
        part.append_batch(df, "bronze", f"bronze_{table}", n)

    append(renamed(orders.limit(2), "new_", "order_id"), "orders", 7, 0)
    assert batch.catch_up(part, "2024-03-01 01:00:00")
    append(renamed(orders.limit(1), "lagging_", "order_id"), "orders", 8, 60)
    append(renamed(orders.limit(1), "equal_", "order_id"), "orders", 9, 0)
    append(renamed(items.limit(3), "late_", "order_item_id"), "order_items", 3)
    append(renamed(ratings.limit(2), "late_", "rating_id"), "ratings", 0)
    moved = ratings.limit(1).withColumn("rating_time", F.col("rating_time") + F.expr("INTERVAL 2 DAYS"))
    append(fixed(moved), "ratings", 1)
    assert batch.catch_up(part, "2024-03-01 04:00:00")
    assert part.read("gold", "fact_orders").filter("order_id LIKE 'lagging%' OR order_id LIKE 'equal%'").count() == 2
    assert part.read("silver", "silver_order_items").filter("order_item_id LIKE 'late%'").count() == 3
    assert part.read("gold", "fact_ratings").count() == ratings.count() + 2
    assert batch.catch_up(part, "2024-03-01 05:00:00") == []

    whole = Lake(spark, part.root + "_whole")
    for t in BRONZE:
        whole.replace(part.read("bronze", f"bronze_{t}").drop("order_date", "rating_date"), "bronze", f"bronze_{t}")
    batch.run_batch(whole, "2024-03-01 04:00:00")
    for layer, table in whole.tables():
        if table not in ("dim_date", "dim_drivers", "dim_restaurants", "dim_menu_items"):
            assert without_stamps(part.read(layer, table)) == without_stamps(whole.read(layer, table)), table


def test_arrivals_pass_the_gate_first(lake, with_late_rows):
    part = with_late_rows("gated")
    batch.run_batch(part, AS_OF)
    lines = part.read("bronze", "bronze_order_items").select(*BRONZE["order_items"].names).limit(60)
    lost = lines.withColumns({c: F.concat(F.lit("lost_"), F.col(c)) for c in ("order_id", "order_item_id")})
    part.append_batch(lake.spark.createDataFrame(lost.collect(), lost.schema), "bronze", "bronze_order_items", 4)
    before = part.safe_count("silver", "silver_order_items")
    with pytest.raises(QualityGateError, match="order_id has no order: 60 of 60"):
        batch.catch_up(part, "2024-03-02 00:00:00")
    assert part.safe_count("silver", "silver_order_items") == before


def test_facts_take_the_version_of_their_day(lake, tmp_path):
    """A restaurant renamed by a second load keeps its old key on the orders before it."""
    other = copy_of(lake, tmp_path / "lake")
    silver = other.read("silver", "silver_restaurants")
    other.replace(lake.spark.createDataFrame(silver.withColumn("restaurant_name", F.concat("restaurant_name", F.lit(" II")))
                                             .collect(), silver.schema), "silver", "silver_restaurants")
    batch.run_gold(other, "2024-03-02 00:00:00")
    dim = other.read("gold", "dim_restaurants")
    closed = dim.filter("NOT is_current").select("restaurant_key")
    assert closed.count() * 2 == dim.count()
    assert other.read("gold", "fact_orders").join(closed, "restaurant_key", "left_semi").count() == 600
