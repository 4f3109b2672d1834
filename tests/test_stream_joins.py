"""Streamed lines joined to their orders, and the state of orders across days and batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_streaming import AS_OF, NOW, messages, put

from courierlake.operators import clean, facts
from courierlake.schemas import BRONZE, GOLD_COLUMNS, WIRE_ORDER_ITEMS
from courierlake.sources.lake import Lake
from courierlake.streaming import ingest, joined, refine, state

START = datetime(2024, 2, 20, 12)


def orders_of(spark, *rows):
    """(id, hours after START, status)"""
    return spark.createDataFrame(
        [(i, f"c{i}", "r1", "d1", START + timedelta(hours=h), s, None, 10.5, None, None, 1.25) for i, h, s in rows],
        BRONZE["orders"])


def items_of(spark, *rows):
    """(line id, order id, hours after START)"""
    return spark.createDataFrame([(i, o, "menu1", 2, 3.335, START + timedelta(hours=h)) for i, o, h in rows],
                                 BRONZE["order_items"])


def run(query):
    assert query.awaitTermination(180)
    assert query.exception() is None


def test_lines_before_after_and_without_their_order(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    folders = {t: str(tmp_path / t) for t in ("orders", "items")}
    day = 24

    def step(n, orders, items):
        put(folders["orders"], f"{n}.json", messages(orders_of(spark, *orders)))
        put(folders["items"], f"{n}.json", messages(items_of(spark, *items), WIRE_ORDER_ITEMS))
        run(joined.start_lines(lake, *(ingest.file_messages(spark, folders[t]) for t in ("orders", "items")), AS_OF,
                               checkpoint=str(tmp_path / "ckpt"), trigger=NOW))

    step(1, [("o1", 0, "placed")], [("l1", "o1", 0), ("l2", "o2", 1), ("lost", "none", 1), ("far", "o1", 5)])
    assert {r.order_id for r in lake.read("gold", "fact_order_items_stream").collect()} == {"o1"}
    # the order of l2 comes in a later run, a line of o1 and a repeat of l1 as well
    step(2, [("o2", 1, "placed"), ("o1", 0, "delivered")], [("l3", "o1", 0), ("l1", "o1", 0)])
    for n in (3, 4, 5):  # time passes on both topics, so what found no partner comes out
        step(n, [(f"t{n}", day * 4 * n - day * 4, "placed")], [(f"lt{n}", f"t{n}", day * 4 * n - day * 4)])
    got = lake.read("gold", "fact_order_items_stream").filter("order_id LIKE 'o%'")
    lines = clean.clean_order_items(items_of(spark, ("l1", "o1", 0), ("l2", "o2", 1), ("l3", "o1", 0)), AS_OF)
    placed = facts.fact_orders(clean.clean_orders(orders_of(spark, ("o1", 0, "delivered"), ("o2", 1, "placed")), AS_OF),
                               None, None, None)
    want = facts.fact_order_items(lines, placed, None, None)
    columns = GOLD_COLUMNS["fact_order_items"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    lost = lake.read("silver", "orphan_order_items_stream").collect()
    assert sorted(r.order_item_id for r in lost) == ["far", "lost"]


def test_an_order_has_one_row_over_any_days(spark, tmp_path):
    lake, folder = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "in")

    def step(n, *rows):
        put(folder, f"{n}.json", messages(orders_of(spark, *rows)))
        run(state.start_orders(lake, ingest.file_messages(spark, folder), AS_OF, checkpoint=str(tmp_path / "ckpt"),
                               trigger=NOW))
        held = lake.read("gold", "fact_orders_stream").collect()
        assert len({r.order_id for r in held}) == len(held)
        return {r.order_id: (r.order_day.day, r.status) for r in held}

    assert step(1, ("a", 0, "placed"), ("b", 0, "placed")) == {"a": (20, "placed"), "b": (20, "placed")}
    # b moves to another day, c is new; the state lives in the checkpoint of another query
    assert step(2, ("b", 48, "ready"), ("c", 24, "placed")) == {
        "a": (20, "placed"), "b": (22, "ready"), "c": (21, "placed")}
    assert step(3, ("b", 0, "delivered"), ("c", 24, "placed")) == {
        "a": (20, "placed"), "b": (20, "delivered"), "c": (21, "placed")}


def test_changes_by_arrival_and_timer(spark, tmp_path):
    """Older arrivals change nothing; a state that expired is forgotten."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", state.STORE)
    folder = str(tmp_path / "in")
    schema = "order_id string, order_time timestamp, status string, arrival_time timestamp"

    def step(*rows):
        spark.createDataFrame([(i, START + timedelta(days=d), s, START + timedelta(hours=h)) for i, d, s, h in rows],
                              schema).coalesce(1).write.mode("append").parquet(folder)
        out = []
        query = (state.order_changes(spark.readStream.schema(schema).parquet(folder), keep_days=3)
                 .writeStream.foreachBatch(lambda b, n: out.extend(b.collect())).outputMode("append")
                 .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        run(query)
        return sorted((r.order_id, r.op, r.day) for r in out)

    assert step(("a", 0, "placed", 5), ("a", 0, "ready", 6)) == [("a", "put", "2024-02-20")]
    assert step(("a", 0, "placed", 4)) == []
    assert step(("a", 1, "ready", 7), ("b", 0, "placed", 7)) == [
        ("a", "put", "2024-02-21"), ("a", "retract", "2024-02-20"), ("b", "put", "2024-02-20")]
    assert step(("z", 0, "placed", 24 * 30)) == [("z", "put", "2024-02-20")]
    step(("z", 0, "ready", 24 * 30 + 1))
    assert step(("a", 2, "ready", 24 * 31)) == [("a", "put", "2024-02-22")]


def test_refresh_moves_an_order_between_days(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for n, row in enumerate([("a", 0, "placed"), ("a", 50, "ready")]):
        batch = orders_of(spark, row).withColumn("arrival_time", F.lit(str(START + timedelta(hours=n))).cast("timestamp"))
        refine.refresh_from_stream(lake, batch, n)
    assert [(r.order_id, r.order_day.day) for r in lake.read("gold", "fact_orders_stream").collect()] == [("a", 22)]
