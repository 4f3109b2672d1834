"""Helpers that several operators share: settled tables, running totals, connected components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW_ROWS = 1_000
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Let executors import this package, also where it isn't installed on them; once per session."""
    sc = spark.sparkContext
    if not getattr(sc, "_courierlake_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="ship-"), "courierlake")
        sc.addPyFile(shutil.make_archive(base, "zip", top, "courierlake"))
        sc._courierlake_shipped = True
        # Whole texts are large rows: smaller Arrow batches than the default of 10,000 rows keep workers small.
        if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def workspace(spark: SparkSession) -> str:
    """A new folder below the shared one that spark.checkpoint.dir names; a temporary one only in local mode."""
    ship(spark)
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(sc, "_courierlake_work", None)
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = sc._courierlake_work = f"file://{tempfile.mkdtemp(prefix='llm-')}"
    return f"{root.rstrip('/')}/llm/{uuid.uuid4().hex}"


def settle(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Written and read again: later steps start from the files, also after executors were lost."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, folder: str, name: str) -> None:
    """Remove a settled table that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def width(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value: Column, body) -> Column:
    """body(value) with `value` worked out once, also where `body` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text, a word being a run without ASCII white space; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def first_of_equals(docs: DataFrame) -> DataFrame:
    """One row per doc_id and text: the one whose other columns, as JSON, have the smallest hash.

    The choice is the same in every run. The rank filter runs before the shuffle as well, so a task sends one row of
    an id, however many there are.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    place = Window.partitionBy("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))), F.isnull("text")).orderBy(
        F.xxhash64(F.to_json(row)))
    return (docs.withColumn("_place", F.row_number().over(place)).filter("_place = 1")
            .select(*(F.col(f"`{c}`") for c in docs.columns)))


def running_totals(df: DataFrame, by: list[str], order: list[str], value: str, out: str, folder: str,
                   name: str) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the same `by` that come before in `order`.

    Rows are dealt by range of (by, order), so one hot key spreads over many tasks; each task sums its own rows,
    and a table of one total per task and key gives the offsets. `order` must name every row apart within `by`,
    else equal rows come in any order. The result is settled in `folder`.
    """
    spark = df.sparkSession
    kept = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()),
                         T.StructField(out, T.LongType())])

    def local_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, 0
        for batch in batches:
            if not len(batch):
                continue
            amount = batch[value].to_numpy(np.int64)
            before = np.cumsum(amount) - amount
            if by:
                same = np.ones(len(batch) - 1, bool)
                for c in by:
                    col = batch[c].to_numpy(object)
                    same &= (col[1:] == col[:-1]) | (pd.isna(col[1:]) & pd.isna(col[:-1]))
                first = np.concatenate([[0], np.flatnonzero(~same) + 1])
                head = tuple(None if pd.isna(x) else x for x in batch[by].iloc[0])
                tail = tuple(None if pd.isna(x) else x for x in batch[by].iloc[-1])
            else:
                first, head, tail = np.array([0]), (), ()
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(batch))))
            before = before - before[first][run]
            carried = total if head == key else 0
            before[run == 0] += carried
            total = int(before[-1] + amount[-1])
            key = tail
            yield batch.assign(**{out: before})

    dealt = (df.repartitionByRange(width(spark), *by, *order).withColumn("_part", F.spark_partition_id())
             .sortWithinPartitions(*by, *order).mapInPandas(local_sums, kept))
    local = settle(dealt, folder, name)
    totals = local.groupBy("_part", *by).agg(F.max(F.col(out) + F.col(value)).alias("_total"))
    columns = ", ".join(f"`{c}`" for c in by)
    offsets = totals.withColumn("_offset", F.expr(
        f"coalesce(sum(_total) over ({'partition by ' + columns if by else ''} order by _part "
        "rows between unbounded preceding and 1 preceding), 0)")).drop("_total")
    joined = local.alias("l").join(offsets.alias("o"), F.expr(" AND ".join(
        ["l._part = o._part", *(f"l.`{c}` <=> o.`{c}`" for c in by)])))
    return joined.select(*(F.col(f"l.`{c}`") for c in df.columns),
                         (F.col(f"l.`{out}`") + F.col("o._offset")).alias(out))


def components(edges: DataFrame, folder: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a long, b long): root is the smallest node that links reach.

    Rounds of large-star and small-star: every round replaces a node's links by links to its smallest neighbour,
    until nothing changes, which takes about log2 of the nodes' number. Minima come from aggregates with a
    map-side part, and a hub's links are one side of plain joins, which adaptive execution splits.
    """
    spark = edges.sparkSession
    links = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), folder, "links-0")
    state = None
    for n in range(1, most_rounds + 1):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = settle(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), folder, f"links-{n}")
        seen = found.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(spark, folder, f"links-{n - 1}")
        links = found
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"links still change after {most_rounds} rounds")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
