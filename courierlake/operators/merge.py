"""Keyed updates of tables that have no MERGE of their own."""

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence) -> DataFrame:
    """One row per key, the first in `newest_first` order (which should settle every tie).

    Spark turns the rank filter into a group limit that runs before the shuffle
    as well, so each task sends at most one row per key, however hot.
    """
    order = [F.desc(c) if isinstance(c, str) else c for c in newest_first]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def newest_state(df: DataFrame, key: str) -> DataFrame:
    """One row per key of a bronze table: the last to arrive, by broker time, batch and then content.

    Rows without the key stay, for the rules to reject.
    """
    first = [c for c in ("arrival_time", "batch_id") if c in df.columns]
    order = [*first, *(c for c in df.columns if c not in (*first, key))]
    keyed = dedup_latest(df.filter(F.col(key).isNotNull()), [key], [F.col(c).desc_nulls_last() for c in order])
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           insert: bool = False) -> DataFrame:
    """Target with `update_cols` taken from source where the keys match, and new keys added with `insert`.

    One join reads each side once. A matched value replaces the old one even when
    it is null. A key that `source` holds twice stops the query, as MERGE does
    (see `dedup_latest`); a null key matches nothing.
    """
    keys = list(keys)
    fields = [c for c in target.columns if c in source.columns and c not in keys] if insert else list(update_cols)
    given = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(*(F.col(c) for c in fields))).alias("_row"))
    known = reduce(and_, (F.col(k).isNotNull() for k in keys))
    patch = given.select(*keys, F.when(known & (F.col("_copies") > 1), F.raise_error(
        F.concat_ws(" ", F.lit("several source rows for key"), *(F.col(k).cast("string") for k in keys))))
        .otherwise(F.col("_row")).alias("_new"))
    held = target.withColumn("_held", F.lit(True))
    joined = held.join(patch, keys, "full" if insert else "left")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in update_cols:
            return F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c))
        return F.when(F.col("_held").isNull(), F.col("_new")[c]).otherwise(F.col(c)) if c in fields else F.col(c)

    return joined.select(*(value(c).alias(c) for c in target.columns))


def touched_parts(target: DataFrame, source: DataFrame, keys: Sequence[str], part: str, insert: bool) -> DataFrame:
    """(`part`, rows): the partitions that hold keys of `source`, and with `insert` those its rows would go to.

    Of the target only the keys and the partition column are read.
    """
    met = target.select(*keys, part).join(source.select(*keys).distinct(), list(keys)).select(part)
    if insert:
        met = met.unionByName(source.select(part))
    return met.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))


def merge_into(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
               folder: str, insert: bool = False) -> DataFrame:
    """`upsert` into a catalog table split by one column; partitions without a key of `source` keep their files.

    The touched partitions are found first and written below `folder` (one row each), so that the join back to the
    table is small enough for Spark to broadcast and prunes the table's scan while it runs. The merged rows then
    replace those partitions by dynamic overwrite. Returns the touched partitions. `source` is read twice and must
    give the same rows both times. Rows don't change their partition: its column can't be updated, and a matched
    row keeps it whatever `source` says.
    """
    target = spark.table(table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if len(parts) != 1:
        raise ValueError(f"{table} is split by {parts}, not by one column")
    part, = parts
    if part in update_cols or part in keys:
        raise ValueError(f"{part} splits {table} and can be neither key nor updated")
    path = f"{folder.rstrip('/')}/merge-{uuid.uuid4().hex}"
    found = touched_parts(target, source, keys, part, insert)
    found.write.parquet(path)
    touched = spark.read.schema(found.schema).parquet(path)
    held = _held_rows(target, touched, part)
    merged = upsert(held, source, keys, update_cols, insert).hint("rebalance", F.col(part))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        merged.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return touched


def _held_rows(target: DataFrame, touched: DataFrame, part: str) -> DataFrame:
    """Rows of the touched partitions, the one without a value included."""
    held = target.join(touched.filter("rows > 0").select(part), part, "left_semi").select(*target.columns)
    if touched.filter(F.col(part).isNull()).isEmpty():
        return held
    return held.unionByName(target.filter(F.col(part).isNull()))
