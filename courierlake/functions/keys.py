"""Surrogate keys made from the business key, so a rerun or a lost executor gives the same keys."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def hash_key(*cols: str | Column) -> Column:
    """Key of a fact row, the MD5 of its business key in hex: no shuffle, the same before and after late rows
    arrive and in any engine. 128 bits keep the keys of 10^15 rows apart with odds of a billion to one.
    """
    return F.md5(F.concat_ws("|", *(F.col(c) if isinstance(c, str) else c for c in cols)).cast("binary"))


def bucket_of(key: Column, digits: int = BUCKET_DIGITS) -> Column:
    """One of 16^digits buckets, taken from the digest of the key."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, digits), 16, 10).cast("bigint")


def numbered(df: DataFrame, key: str, into: str, after: Column | None = None,
             only: Column | None = None, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number rows uniquely in column `into`, counting from `after` + 1.

    One global row_number would send every row to one task. Here each digest
    bucket counts its own rows and strides over the other buckets, so keys are
    unique but not dense. Rows where `only` is false keep what `into` holds.
    """
    stride = 16**digits
    bucket = bucket_of(F.col(key), digits)
    fresh = F.lit(True) if only is None else only
    order = [F.col(key)] if only is None else [only.desc(), F.col(key)]
    place = F.row_number().over(Window.partitionBy(bucket).orderBy(*order)).cast("bigint")
    base = F.lit(0).cast("bigint") if after is None else F.coalesce(after, F.lit(0)).cast("bigint")
    number = base + (place - 1) * stride + bucket + 1
    if only is None:
        return df.withColumn(into, number)
    return df.withColumn(into, F.when(fresh, number).otherwise(F.col(into)))


def registered(registry: DataFrame | None, source: DataFrame, key: str, into: str,
               digits: int = BUCKET_DIGITS) -> DataFrame:
    """The registry (key, `into`) with the keys of `source` that it lacks numbered on from its last number.

    Numbers are dense from 1 and never move: a key keeps its number while it is away and when it comes back, and the
    order of rows in `source` doesn't matter. Unseen keys are numbered by digest bucket and then by key: buckets count
    apart, and the running total of at most 16^digits bucket sizes gives each its offset, so no task holds all keys.
    Null keys get none. Write the result before it is used for more than one thing.
    """
    unseen = source.select(key).filter(F.col(key).isNotNull()).distinct()
    if registry is None:
        last = F.lit(0).cast("bigint")
    else:
        unseen = unseen.join(registry.select(key), key, "left_anti")
        last = F.coalesce(registry.agg(F.max(into)).scalar(), F.lit(0)).cast("bigint")
    dealt = unseen.withColumn("_bucket", bucket_of(F.col(key), digits))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # over bucket sizes, not over keys
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    fresh = dealt.withColumn("_place", place).join(offsets, "_bucket").withColumn("_last", last).select(
        key, (F.col("_last") + F.col("_offset") + F.col("_place")).cast("bigint").alias(into))
    return fresh if registry is None else registry.select(key, into).unionByName(fresh)
