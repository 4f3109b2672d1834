"""One state per order across batches: what a batch changes, as rows to take back and rows to put.

An order may come again on any day, with another time and so on another day. The state of an order is the row that
holds now; an arrival that is newer replaces it, which takes the old row off its day and puts the new one on its own.
State is dropped `keep_days` after the last change, by a timer on the watermark. Needs Spark's RocksDB state store.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from courierlake.operators import clean, facts
from courierlake.session import checkpoint_root, tune
from courierlake.sources.lake import ARRIVAL, Lake
from courierlake.sources.wire import DECODERS, readable
from courierlake.streaming.ingest import TRIGGER
from courierlake.streaming.refine import WATERMARK

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEEP_DAYS = 90
FACTS = "fact_orders_stream"
RETRACT, PUT = "retract", "put"
DAY_MS = 86_400_000
AS_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class OrderState(StatefulProcessor):
    """Rows of one order, their content as one JSON text, to changes (order_id, op, day, content)."""

    def __init__(self, keep_days: int):
        self.keep_ms = keep_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "arrived bigint, content string, day string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        # ties of the arrival time go by content, so the outcome does not depend on the order of rows
        newest = max(zip(came["arrived"].tolist(), came["content"].tolist(), came["day"].fillna("").tolist()))
        old = self.held.get() if self.held.exists() else None
        if old is not None and (old[0], old[1]) >= newest[:2]:
            return iter([])
        self.held.update(newest)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), newest[0] // 1000) + self.keep_ms)
        changes = [(key[0], PUT, newest[2], newest[1])]
        if old is not None:
            changes.insert(0, (key[0], RETRACT, old[2], old[1]))
        return iter([pd.DataFrame(changes, columns=["order_id", "op", "day", "content"])])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def order_changes(scored: DataFrame, keep_days: int = KEEP_DAYS, watermark: str = WATERMARK) -> DataFrame:
    """Per batch and order: the row to take back, if one held, and the row to put; from a stream of scored orders.

    A batch that brings an order several times yields its newest state only. `content` is the row as JSON.
    """
    rows = scored.withWatermark(ARRIVAL, watermark).select(
        "order_id", F.unix_micros(ARRIVAL).alias("arrived"), F.to_date("order_time").cast("string").alias("day"),
        F.to_json(F.struct(*scored.columns), AS_JSON).alias("content"))
    return rows.groupBy("order_id").transformWithStateInPandas(
        OrderState(keep_days), "order_id string, op string, day string, content string", "append", "eventtime")


def apply_changes(lake: Lake, changes: DataFrame, schema: T.StructType, as_of) -> None:
    """Rewrite the days that changes take rows from or put rows on; running a batch again changes nothing."""
    days = [r[0] for r in changes.select(F.to_date(F.nullif("day", F.lit("")))).distinct().collect()]
    put = changes.filter(F.col("op") == PUT).select(F.from_json("content", schema, AS_JSON).alias("r")).select("r.*")
    drivers, restaurants = (lake.read_or_none("gold", t) for t in ("dim_drivers", "dim_restaurants"))
    fresh = facts.recent_fact_orders(put, drivers, restaurants, as_of)
    held = lake.read_or_none("gold", FACTS)
    if held is not None:
        ids = changes.select("order_id").distinct()
        on_days = F.col("order_day").isin([d for d in days if d is not None]) | F.col("order_day").isNull()
        rest = held.filter(on_days).join(ids, "order_id", "left_anti").select(*fresh.columns)
        fresh = rest.unionByName(fresh)
    lake.replace_days(fresh, "gold", FACTS, [d for d in days if d is not None])


def start_orders(lake: Lake, messages: DataFrame, as_of, checkpoint: str | None = None, trigger: dict | None = None,
                 keep_days: int = KEEP_DAYS) -> StreamingQuery:
    """Messages of orders to `fact_orders_stream`, which holds one row per order over any days and batches.

    `as_of` stands for "now" where rows are scored and stamped.
    """
    tune(lake.spark)
    lake.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    scored = clean.score_orders(readable(DECODERS["orders"](messages)), as_of)
    schema = scored.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                apply_changes(lake, batch, schema, as_of)
        finally:
            batch.unpersist()

    return (order_changes(scored, keep_days).writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint or f"{checkpoint_root(lake.spark, lake.root)}/order-states")
            .trigger(**(trigger or {"processingTime": TRIGGER})).queryName("order_states").start())
