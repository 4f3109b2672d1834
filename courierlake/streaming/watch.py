"""How far streams lag: one row per batch of each query, from Spark's own progress reports."""

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from courierlake.operators.late import ACCEPTED_HOURS, ON_TIME_MINUTES

PROGRESS = ("query string, batch_id bigint, started string, rows bigint, unreadable bigint, late_rows bigint, "
            "max_lag_seconds bigint, watermark string, state_rows bigint, dropped_rows bigint")


class StreamWatch(StreamingQueryListener):
    """Keeps the progress of all queries of a session until `store` writes it.

    Spark calls back on the driver once per batch, so a batch is one small row, whatever it holds. The lag and the
    unreadable rows are observed by the query itself (see `ingest.start_ingest`) and null for queries that don't.
    """

    def __init__(self, observed: str = "ingest"):
        self.observed = observed
        self._rows: list[tuple] = []
        self._running = 0
        self._lock = Condition()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._running += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._running -= 1
            self._lock.notify_all()

    def wait(self, seconds: float) -> bool:
        """Until the end of every query was reported, and with it its batches."""
        with self._lock:
            return self._lock.wait_for(lambda: self._running <= 0, seconds)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.observed)
        seen = seen.asDict() if seen is not None else {}
        row = (p.name, p.batchId, p.timestamp, p.numInputRows, seen.get("unreadable"), seen.get("late"),
               seen.get("max_lag_seconds"), p.eventTime.get("watermark"),
               sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        with self._lock:
            self._rows.append(row)

    def store(self, spark: SparkSession, folder: str) -> int:
        """Append what was reported since the last call to a Parquet folder; returns the batches written."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(folder)
        return len(rows)


@contextmanager
def watched(spark: SparkSession, folder: str, wait_seconds: float = 30) -> Iterator[StreamWatch]:
    """Queries that start and end inside have their batches stored in `folder`, also when one of them fails."""
    watch = StreamWatch()
    spark.streams.addListener(watch)
    try:
        yield watch
    finally:
        watch.wait(wait_seconds)
        spark.streams.removeListener(watch)
        watch.store(spark, folder)


def stream_health(progress: DataFrame) -> DataFrame:
    """Per batch: the share of unreadable rows, and OK, Warning or Critical by its latest row.

    A batch that was reported twice, as after a restart, counts once. Batches without a lag have no level.
    """
    once = progress.groupBy("query", "batch_id").agg(F.max_by(F.struct(*progress.columns), "started").alias("p")).select("p.*")
    lag = F.col("max_lag_seconds")
    return once.withColumns({
        "unreadable_share": F.when(F.col("rows") > 0, F.col("unreadable") / F.col("rows")),
        "level": F.when(lag.isNull(), F.lit(None)).when(lag <= ON_TIME_MINUTES * 60, F.lit("OK"))
        .when(lag <= ACCEPTED_HOURS * 3600, F.lit("Warning")).otherwise(F.lit("Critical"))})
