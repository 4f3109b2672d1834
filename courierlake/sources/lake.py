"""Tables of the three layers as Parquet folders that Spark reads and writes.

A full rebuild goes to a new folder `v=<n>`, and a pointer then names it: readers
see the old version or the new one, never a half-written folder, and a job may
read the table it replaces. The pointer has two slots written in turn, so while
one is replaced the other still names the version before. Changes of single days
and stream batches use Spark's dynamic partition overwrite inside the current
version.
"""

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake.schemas import BRONZE, LAYERS, PARTITIONED

BATCH = "batch_id"
LOADED = -(1 << 40)  # batch_id of rows that came by a load, not by a stream; later loads count up from it
ARRIVAL = "arrival_time"  # when the source took a record; null for loaded rows
STREAMED = ("bronze_orders", "bronze_order_items", "bronze_ratings")
POINTER = "version bigint, columns string"


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._viewed: set[tuple[str, str]] = set()

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # --- versions -------------------------------------------------------------

    def _pointer(self, layer: str, table: str):
        """Newest version and its columns; None when there is no such table."""
        slots = f"{self.path(layer, table)}/current"
        if not self._is_there(slots):
            return None
        found = (self.spark.read.schema(POINTER).option("ignoreMissingFiles", "true").json(slots)
                 .select("version", "columns").collect())  # two rows at most
        return max(found, key=lambda r: r.version, default=None)

    def _is_there(self, path: str) -> bool:
        """Whether a path exists on whatever file system the lake is on."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def _point(self, layer: str, table: str, version: int, schema: T.StructType) -> None:
        line = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"), F.lit(schema.json()).alias("columns"))
        line.coalesce(1).write.mode("overwrite").json(f"{self.path(layer, table)}/current/slot={version % 2}")

    def version(self, layer: str, table: str) -> int | None:
        pointer = self._pointer(layer, table)
        return None if pointer is None else pointer.version

    def exists(self, layer: str, table: str) -> bool:
        return self._is_there(f"{self.path(layer, table)}/current")

    # --- reading --------------------------------------------------------------

    def read_or_none(self, layer: str, table: str) -> DataFrame | None:
        pointer = self._pointer(layer, table)
        if pointer is None:
            return None
        schema = T.StructType.fromJson(json.loads(pointer.columns))
        # the stored schema spares the footer scan and serves a table without rows
        return (self.spark.read.schema(schema).parquet(f"{self.path(layer, table)}/v={pointer.version}")
                .select(*schema.names))

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """The table as it is now, or an earlier version of it."""
        if version is not None:
            return self.spark.read.parquet(f"{self.path(layer, table)}/v={version}")
        df = self.read_or_none(layer, table)
        if df is None:
            raise ValueError(f"no table {layer}.{table}")
        return df

    def sample(self, layer: str, table: str, n: int = 5) -> DataFrame:
        """Any n rows, for a look at a table."""
        return self.read(layer, table).limit(n)

    def safe_count(self, layer: str, table: str) -> int:
        """Rows in a table, 0 when it does not exist."""
        df = self.read_or_none(layer, table)
        return 0 if df is None else df.count()

    # --- writing --------------------------------------------------------------

    @staticmethod
    def _stored(df: DataFrame, table: str, batch_id: int | None = None) -> tuple[DataFrame, list[str]]:
        """The frame with the columns a table adds to it, and the columns that split the table."""
        partitions = []
        if table in PARTITIONED:
            column, source = PARTITIONED[table]
            day = F.to_date(F.col(source).cast("string"), "yyyyMMdd") if source == "date_key" else F.to_date(source)
            df, partitions = df.withColumn(column, day), [column]
        if table in STREAMED and ARRIVAL not in df.columns:
            df = df.withColumn(ARRIVAL, F.lit(None).cast("timestamp"))
        if batch_id is not None:
            df = df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        elif table in STREAMED and BATCH not in df.columns:
            df = df.withColumn(BATCH, F.lit(LOADED).cast("bigint"))
        if BATCH in df.columns:
            partitions.append(BATCH)
        return df, partitions

    @staticmethod
    def _write(df: DataFrame, path: str, partitions: list[str], dynamic: bool = False) -> int:
        """One action: the row count is observed while the rows are written."""
        seen = Observation()
        if partitions:
            # few files per day, and a day that holds much of the data is split over tasks
            df = df.hint("rebalance", *[F.col(c) for c in partitions])
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if partitions:
            writer = writer.partitionBy(*partitions)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
        return seen.get.get("n", 0)

    def replace(self, df: DataFrame, layer: str, table: str) -> int:
        """The whole table anew; returns the rows written."""
        df, partitions = self._stored(df, table)
        version = (self.version(layer, table) or 0) + 1
        rows = self._write(df, f"{self.path(layer, table)}/v={version}", partitions)
        self._point(layer, table, version, df.schema)
        if (layer, table) in self._viewed:
            self._view(layer, table)
        return rows

    def compact_days(self, layer: str, table: str, days: Sequence[date]) -> int:
        """Closed days of a streamed table as few files; their batches can't be written again afterwards.

        Readers may see a row twice while the old files are being removed.
        """
        rows = self.read(layer, table).filter(F.col(PARTITIONED[table][0]).isin(list(days)))
        return self.replace_days(rows.withColumn(BATCH, F.lit(LOADED).cast("bigint")), layer, table, days)

    def remove_old_versions(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Drop all but the newest `keep` versions; returns those removed. No reader may still use them."""
        newest = self.version(layer, table) or 0
        gone = [v for v in range(1, newest - keep + 1) if self._is_there(f"{self.path(layer, table)}/v={v}")]
        for v in gone:
            self._delete(f"{self.path(layer, table)}/v={v}")
        return gone

    def replace_days(self, df: DataFrame, layer: str, table: str, days: Sequence[date] = ()) -> int:
        """The days that `df` has rows for, leaving all other days as they are.

        Of the `days` named, those without rows are emptied. In a table that streams
        write, a day is replaced per batch: give back every row of the day with its batch_id.
        """
        if table not in PARTITIONED:
            raise ValueError(f"{table} is not split by day")
        version = self.version(layer, table)
        if version is None:
            return self.replace(df, layer, table)
        df, partitions = self._stored(df, table)
        path = f"{self.path(layer, table)}/v={version}"
        folders = [f"{path}/{partitions[0]}={day}" for day in days]
        old = {f: self._files(f) for f in folders}
        rows = self._write(df, path, partitions, dynamic=True)
        for folder in folders:
            for stale in old[folder] & self._files(folder):  # the write would have replaced it
                self._delete(stale)
        return rows

    def _files(self, folder: str) -> set[str]:
        """Data files below a folder."""
        if not self._is_there(folder):
            return set()
        where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed, found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listFiles(where, True), set()
        while listed.hasNext():
            found.add(listed.next().getPath().toString())
        return {f for f in found if f.rsplit("/", 1)[1].startswith("part-")}

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def append_batch(self, df: DataFrame, layer: str, table: str, batch_id: int) -> int:
        """Rows of one stream batch. Writing the same batch again replaces it, so a retry adds nothing."""
        df, partitions = self._stored(df, table, batch_id)
        version = self.version(layer, table)
        if version is None:
            version = 1
            self._point(layer, table, version, df.schema)
        return self._write(df, f"{self.path(layer, table)}/v={version}", partitions, dynamic=True)

    def append_or_create(self, df: DataFrame, layer: str, table: str) -> None:
        self.append(df, layer, table) if self.exists(layer, table) else self.replace(df, layer, table)

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        """Plain append to an existing table of the same columns."""
        target = self.read(layer, table)
        # each load is a batch of its own, so that a run can tell which loads it has taken in
        load = None
        if BATCH in target.columns and BATCH not in df.columns:
            last = target.filter(F.col(BATCH) < 0).agg(F.max(BATCH)).first()[0]
            load = LOADED if last is None else last + 1
        stored, partitions = self._stored(df, table, load)
        if sorted(stored.columns) != sorted(target.columns):
            raise ValueError(f"{layer}.{table} has columns {target.columns}, not {df.columns}")
        writer = stored.write.mode("append")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(f"{self.path(layer, table)}/v={self.version(layer, table)}")

    def batches(self, layer: str, table: str) -> DataFrame:
        """The batch ids a table holds, from its partition values."""
        return self.read(layer, table).select(BATCH).distinct()

    def ensure(self, layer: str, table: str, schema: T.StructType) -> None:
        """An empty table when there is none yet."""
        if not self.exists(layer, table):
            self.replace(self.spark.createDataFrame([], schema), layer, table)

    def ensure_bronze(self) -> None:
        for table, schema in BRONZE.items():
            self.ensure("bronze", f"bronze_{table}", schema)

    # --- catalog --------------------------------------------------------------

    def tables(self) -> list[tuple[str, str]]:
        return [(layer, t) for layer, names in LAYERS.items() for t in names if self.exists(layer, t)]

    def register_views(self) -> None:
        """Make every table readable in SQL as <layer>.<table>; tables replaced later move their view along."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for layer, table in self.tables():
            self._view(layer, table)

    def _view(self, layer: str, table: str) -> None:
        df, folder = self.read(layer, table), f"{self.path(layer, table)}/v={self.version(layer, table)}"
        if self._files(folder):
            names = ", ".join(f"`{n}`" for n in df.columns)
            query = f"SELECT {names} FROM parquet.`{folder}`"
        else:
            typed = ", ".join(f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in df.dtypes)
            query = f"SELECT {typed} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS {query}")
        self._viewed.add((layer, table))

    def describe(self) -> DataFrame:
        """One row per column of every table."""
        rows = [(layer, table, f.name, f.dataType.simpleString())
                for layer, table in self.tables() for f in self.read(layer, table).schema]
        return self.spark.createDataFrame(rows, "layer string, table_name string, column string, type string")
