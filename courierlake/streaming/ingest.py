"""Order streams to bronze: source, decode, one idempotent write per micro-batch."""

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierlake.operators.late import ON_TIME_MINUTES
from courierlake.schemas import BRONZE
from courierlake.session import checkpoint_root, tune
from courierlake.sources.lake import Lake
from courierlake.sources.wire import DECODERS, quarantined, readable

TRIGGER = "10 seconds"
IDLE_SECONDS = 60
MAX_SECONDS = 300
METRICS = "ingest"


def kafka_messages(spark: SparkSession, servers: str, topic: str, fail_on_data_loss: bool = True,
                   **options: str) -> DataFrame:
    """A topic from its earliest offset on; the broker's timestamp is the arrival time.

    Offsets that the broker has dropped stop the stream unless the caller accepts the loss. Needs Spark's Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest")
              .option("failOnDataLoss", str(fail_on_data_loss).lower())
              .options(**options))
    return reader.load().select("value", F.col("timestamp").alias("arrival_time"))


def file_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Text files of one message per line; a file's modification time is the arrival time."""
    return (spark.readStream.format("text").options(**options).load(path)
            .select("value", F.col("_metadata.file_modification_time").alias("arrival_time")))


def start_ingest(lake: Lake, table: str, messages: DataFrame, checkpoint: str | None = None,
                 trigger: dict | None = None,
                 then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Stream messages of `table` ('orders' or 'order_items') into bronze.

    Unreadable messages go to a quarantine table. Counts and the longest lag are
    observed on the stream itself, so no batch is counted separately. `then` gets the readable
    rows of each batch, for steps further down (see `streaming.refine`).
    """
    tune(lake.spark)
    lake.ensure("bronze", f"bronze_{table}", BRONZE[table])
    decoded = DECODERS[table](messages)
    counts = [F.count(F.lit(1)).alias("records"), F.count_if(~F.col("decoded")).alias("unreadable")]
    if {"arrival_time", "order_time"} <= set(decoded.columns):
        lag = F.unix_seconds("arrival_time") - F.unix_seconds("order_time")
        counts += [F.max(lag).alias("max_lag_seconds"), F.count_if(lag > ON_TIME_MINUTES * 60).alias("late")]
    decoded = decoded.observe(METRICS, *counts)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = readable(batch)
            lake.append_batch(good, "bronze", f"bronze_{table}", batch_id)
            lake.append_batch(quarantined(batch), "bronze", f"quarantine_{table}", batch_id)
            if then is not None:
                then(good, batch_id)
        finally:
            batch.unpersist()

    return (decoded.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint or f"{checkpoint_root(lake.spark, lake.root)}/ingest/{table}")
            .trigger(**(trigger or {"processingTime": TRIGGER}))
            .queryName(f"bronze_{table}")
            .start())


def run_bounded(queries: Iterable[StreamingQuery], idle_seconds: float = IDLE_SECONDS,
                max_seconds: float = MAX_SECONDS, poll_seconds: float = 1.0) -> dict[str, int]:
    """Wait until the queries end, bring no rows for a while, or run out of time; then stop them.

    Returns the rows each query took in. A query that failed stops all and raises.
    """
    queries = list(queries)
    began = last_rows = time.monotonic()
    rows = {q.name: 0 for q in queries}
    seen: dict[str, int] = {}
    try:
        while True:
            for q in queries:
                failure = q.exception()
                if failure is not None:
                    raise failure
                for p in q.recentProgress:
                    if p.batchId > seen.get(q.name, -1):
                        seen[q.name] = p.batchId
                        rows[q.name] += p.numInputRows
                        if p.numInputRows:
                            last_rows = time.monotonic()
            now = time.monotonic()
            if not any(q.isActive for q in queries):
                return rows
            if now - last_rows > idle_seconds or now - began > max_seconds:
                return rows
            time.sleep(poll_seconds)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
