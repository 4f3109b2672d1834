"""Order items through the stream: each line meets its order by a join of the two topics.

Both sides are watermarked and a line must lie within `apart` of its order, so Spark knows when a waiting row can find
no partner any more and drops it from state: what is held grows with the time span, not with the stream. A line whose
order has not come by then is emitted once, without an order. Lines and orders that the source repeats within the
watermark count once.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierlake.functions.keys import hash_key
from courierlake.operators import clean
from courierlake.operators.joins import with_date_key, with_key
from courierlake.schemas import GOLD_COLUMNS
from courierlake.session import checkpoint_root, tune
from courierlake.sources.lake import Lake
from courierlake.sources.wire import DECODERS, readable
from courierlake.streaming.ingest import TRIGGER
from courierlake.streaming.refine import WATERMARK, dedup_stream

APART = "1 hour"  # a line carries the time of its order; clocks may differ
LINES, LOST = "fact_order_items_stream", "orphan_order_items_stream"


def lines_with_orders(orders: DataFrame, items: DataFrame, watermark: str = WATERMARK, apart: str = APART) -> DataFrame:
    """Every line of a stream of silver items with `known`: whether its order came in time.

    `orders` needs order_id and order_time. Lines outside `apart` of their order count as lost.
    """
    placed = dedup_stream(orders.select("order_id", "order_time"), watermark=watermark).select(
        F.col("order_id").alias("_order"), F.col("order_time").alias("_placed"))
    lines = items.withWatermark("order_time", watermark).dropDuplicatesWithinWatermark(["order_item_id"])
    near = F.expr(f"order_id = _order AND order_time BETWEEN _placed - INTERVAL {apart} AND _placed + INTERVAL {apart}")
    return lines.join(placed, near, "left_outer").withColumn("known", F.col("_order").isNotNull()).drop("_order", "_placed")


def line_facts(lines: DataFrame, menu: DataFrame | None, calendar: DataFrame | None) -> DataFrame:
    """Facts of lines whose order is known, as `facts.fact_order_items` makes them."""
    keyed = with_key(lines.filter("known"), menu, "item_id", "menu_item_key")
    keyed = with_date_key(keyed, calendar, F.to_date("order_time"))
    return keyed.withColumns({"order_item_key": hash_key("order_item_id"), "order_key": hash_key("order_id")}).select(
        *GOLD_COLUMNS["fact_order_items"])


def start_lines(lake: Lake, orders: DataFrame, items: DataFrame, as_of, checkpoint: str | None = None,
                trigger: dict | None = None, watermark: str = WATERMARK, apart: str = APART) -> StreamingQuery:
    """Messages of both topics to `fact_order_items_stream`; lines whose order never came to a table beside it.

    `as_of` stands for "now" in the cleaning rules. A batch written again replaces itself.
    """
    tune(lake.spark)
    silver_orders = clean.clean_orders(readable(DECODERS["orders"](orders)), as_of)
    silver_items = clean.clean_order_items(readable(DECODERS["order_items"](items)), as_of)
    joined = lines_with_orders(silver_orders, silver_items, watermark, apart)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            menu, calendar = (lake.read_or_none("gold", t) for t in ("dim_menu_items", "dim_date"))
            lake.append_batch(line_facts(batch, menu, calendar), "gold", LINES, batch_id)
            lake.append_batch(batch.filter("NOT known").drop("known"), "silver", LOST, batch_id)
        finally:
            batch.unpersist()

    return (joined.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint or f"{checkpoint_root(lake.spark, lake.root)}/lines")
            .trigger(**(trigger or {"processingTime": TRIGGER})).queryName("order_lines").start())
