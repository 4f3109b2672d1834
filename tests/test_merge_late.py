"""Upserts, deduplication, lateness, skewed inputs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courierlake.operators import late, merge

AS_OF = "2024-03-01 12:00:00"


def table(spark, rows):
    return spark.createDataFrame(rows, "order_id string, status string, delivery_time timestamp, note string")


TARGET = [("a", "ready", None, "x"), ("b", "delivered", datetime(2024, 1, 1), "y"), ("c", None, None, "z")]


def test_upsert_updates_matches_only(spark):
    source = table(spark, [("a", "delivered", datetime(2024, 2, 1), None), ("q", "ready", None, None)])
    out = merge.upsert(table(spark, TARGET), source, ["order_id"], ["status", "delivery_time"])
    got = {r.order_id: (r.status, r.delivery_time, r.note) for r in out.collect()}
    assert got == {"a": ("delivered", datetime(2024, 2, 1), "x"), "b": ("delivered", datetime(2024, 1, 1), "y"),
                   "c": (None, None, "z")}
    again = merge.upsert(out, source, ["order_id"], ["status", "delivery_time"])
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_upsert_can_set_null_and_insert(spark):
    source = table(spark, [("b", None, None, "n"), ("q", "ready", None, "n")])
    out = merge.upsert(table(spark, TARGET), source, ["order_id"], ["status"], insert=True)
    got = {r.order_id: (r.status, r.note) for r in out.collect()}
    assert got == {"a": ("ready", "x"), "b": (None, "y"), "c": (None, "z"), "q": ("ready", "n")}


def test_upsert_refuses_a_key_given_twice(spark):
    source = table(spark, [("a", "ready", None, "n"), ("a", "placed", None, "n")])
    for insert in (False, True):
        with pytest.raises(Exception, match="several source rows for key a"):
            merge.upsert(table(spark, TARGET), source, ["order_id"], ["status"], insert=insert).collect()


def test_upsert_reads_the_target_once(spark, small):
    target = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_orderstatus")
    source = spark.read.parquet(f"{small}/lineitem.parquet").selectExpr("l_orderkey AS o_orderkey", "'x' AS o_orderstatus").distinct()
    plan = merge.upsert(target, source, ["o_orderkey"], ["o_orderstatus"], insert=True)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("orders.parquet") == 1


def files_of(spark, table):
    return {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}


def month(number):
    return None if number is None else date(2024, number, 1)


@pytest.mark.parametrize("insert", [False, True])
def test_merge_into_rewrites_only_touched_partitions(spark, tmp_path, insert):
    name = f"merge_{insert}".lower()
    rows = [(n, "ready", month(n % 6 + 1 if n % 7 else None)) for n in range(60)]
    spark.createDataFrame(rows, "id long, status string, month date").repartition(3).write.partitionBy("month").mode(
        "overwrite").saveAsTable(name)
    before = files_of(spark, name)
    # Matches in months 2 and none, one of them under another month than the table's; a new row goes to month 5.
    source = spark.createDataFrame([(1, "done", month(2)), (7, None, month(3)), (100, "new", month(5))],
                                   "id long, status string, month date")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    touched = merge.merge_into(spark, name, source, ["id"], ["status"], str(tmp_path), insert=insert)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert {r.month for r in touched.collect()} == {month(m) for m in ((2, None, 3, 5) if insert else (2, None))}
    changed = {1: "done", 7: None}
    want = {(n, changed.get(n, s), m) for n, s, m in rows} | ({(100, "new", month(5))} if insert else set())
    assert {tuple(r) for r in spark.table(name).collect()} == want
    kept = {f for f in before if any(f"month={month(m)}" in f for m in ((1, 4, 6) if insert else (1, 3, 4, 5, 6)))}
    assert kept and before & files_of(spark, name) == kept


def test_merge_into_prunes_the_scan_and_refuses_moves(spark, tmp_path):
    spark.range(1000).selectExpr("id", "'x' AS status", "id % 10 AS part").write.partitionBy("part").mode(
        "overwrite").saveAsTable("merge_plan")
    source = spark.createDataFrame([(13, "y", 3)], "id long, status string, part long")
    touched = merge.merge_into(spark, "merge_plan", source, ["id"], ["status"], str(tmp_path))
    assert [tuple(r) for r in touched.collect()] == [(3, 1)]
    plan = merge._held_rows(spark.table("merge_plan"), touched, "part")._jdf.queryExecution().executedPlan().toString()
    assert "SubqueryAdaptiveBroadcast" in plan
    assert "dynamicpruningexpression(true)" not in plan
    for keys, columns in ((["id"], ["part"]), (["part"], ["status"])):
        with pytest.raises(ValueError, match="part"):
            merge.merge_into(spark, "merge_plan", source, keys, columns, str(tmp_path))
    none = merge.merge_into(spark, "merge_plan", source.limit(0), ["id"], ["status"], str(tmp_path), insert=True)
    assert none.isEmpty() and spark.table("merge_plan").count() == 1000


def test_dedup_takes_the_newest_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only")],
                               "k string, t int, v string")
    out = merge.dedup_latest(df, ["k"], ["t", "v"])
    assert {r.k: r.v for r in out.collect()} == {"a": "new", "b": "only"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit"), "each task should send one row per key"


def test_small_source_leaves_a_large_target_unshuffled(spark, small):
    target = spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    source = spark.read.parquet(f"{small}/region.parquet").selectExpr(
        "cast(r_regionkey as bigint) AS l_orderkey", "r_name AS l_returnflag")
    plan = merge.upsert(target, source, ["l_orderkey"], ["l_returnflag"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("minutes, label", [(-5, "OK"), (30, "OK"), (31, "Warning"), (48 * 60, "Warning"),
                                            (48 * 60 + 1, "Critical"), (None, None)])
def test_lateness(spark, minutes, label):
    event = datetime(2024, 1, 1)
    df = spark.createDataFrame([(event,)], "e timestamp").withColumn(
        "a", F.col("e") + F.make_dt_interval(mins=F.lit(minutes)))
    assert late.classify_lateness(df, "e", "a").first().lateness == label


def test_confirmations_take_the_latest_report(spark):
    reports = spark.createDataFrame([("a", "delivered", datetime(2024, 2, 2)), ("a", "cancelled", datetime(2024, 2, 1))],
                                    "order_id string, status string, delivery_time timestamp")
    out = late.apply_confirmations(table(spark, TARGET), reports)
    assert out.count() == 3
    assert out.filter("order_id = 'a'").first().status == "delivered"


def test_incomplete_orders_with_and_without_a_limit(spark):
    df = spark.createDataFrame([(f"o{i}", s, datetime(2024, 1, 20 - i)) for i, s in enumerate(
        ["picked_up", "ready", "preparing", "delivered", "placed"])], "order_id string, status string, order_time timestamp")
    assert late.incomplete_orders(df).count() == 3
    assert [r.order_id for r in late.incomplete_orders(df, limit=2).collect()] == ["o2", "o1"]


def test_impact_lists_changed_keys_only(spark):
    before = spark.createDataFrame([("1", 2, 10.0), ("2", 1, 5.0)], "d string, n int, m double")
    after = spark.createDataFrame([("1", 3, 12.5), ("2", 1, 5.0), ("3", 1, 1.0)], "d string, n int, m double")
    out = {r.d: (r.n_delta, r.m_delta) for r in late.impact_report(before, after, ["d"], ["n", "m"]).collect()}
    assert out == {"1": (1.0, 2.5), "3": (1.0, 1.0)}


def test_touched_dates_follow_the_clamp(spark):
    rows = spark.createDataFrame([(datetime(2024, 2, 1),), (datetime(2025, 1, 1),)], "t timestamp")
    got = sorted(str(r.report_date) for r in late.touched_dates(rows, "t", AS_OF).collect())
    assert got == ["2024-02-01", "2024-03-01"]
