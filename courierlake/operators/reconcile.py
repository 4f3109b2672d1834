"""Do two layers hold the same content: order-free fingerprints per day, then the rows behind a difference.

Equal counts say little: a changed amount keeps them. Each row gets 60 bits of the digest of its columns, and a day the
sum of those, which needs no order and one aggregate with a map-side part. Only days that differ are compared by key.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions.exact import cents

NOTHING = "~"  # stands for null in digests


def order_columns(amount: str = "total_amount", tip: str = "tip_amount") -> dict[str, Column]:
    """What bronze, silver and gold orders have in common, as exact text."""
    return {"status": F.col("status"), "total_cents": cents(F.col(amount)).cast("string"),
            "tip_cents": cents(F.col(tip)).cast("string"), "placed": F.unix_seconds("order_time").cast("string")}


def row_print(columns: Mapping[str, Column]) -> Column:
    text = F.concat_ws("|", *(F.coalesce(c, F.lit(NOTHING)) for c in columns.values()))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def fingerprints(df: DataFrame, bucket: Column, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """(bucket, rows, fingerprint) of a table; equal for equal rows, however they are stored."""
    keyed = {key: F.col(key).cast("string"), **columns}
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_print(keyed).cast("decimal(38,0)")).alias("fingerprint"))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose counts or fingerprints differ, with both sides' counts; a bucket may be missing on one side."""
    a = left.select("bucket", F.struct("rows", "fingerprint").alias("l"))
    b = right.select("bucket", F.struct("rows", "fingerprint").alias("r"))
    met = a.join(b, a.bucket.eqNullSafe(b.bucket), "full").filter(~F.col("l").eqNullSafe(F.col("r")))
    return met.select(F.coalesce(a.bucket, b.bucket).alias("bucket"), F.col("l.rows").alias("left_rows"),
                      F.col("r.rows").alias("right_rows"))


def differing_rows(left: DataFrame, right: DataFrame, left_bucket: Column, right_bucket: Column, key: str,
                   left_columns: Mapping[str, Column], right_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """(key, side, columns): keys found on one side only, or the names of the columns that differ.

    Buckets are compared first; only rows of those that differ meet in a join on the key. A key must be unique on
    each side. A row that moved to another bucket shows under its key, as its columns differ or not.
    """
    right_columns = left_columns if right_columns is None else right_columns
    buckets = differing_buckets(fingerprints(left, left_bucket, key, left_columns),
                                fingerprints(right, right_bucket, key, right_columns)).select("bucket")

    def side(df: DataFrame, bucket: Column, columns: Mapping[str, Column], name: str) -> DataFrame:
        rows = df.select(F.col(key), bucket.alias("bucket"), F.struct(*(c.alias(n) for n, c in columns.items())).alias(name))
        return rows.join(buckets, rows.bucket.eqNullSafe(buckets.bucket), "left_semi").drop("bucket")

    both = side(left, left_bucket, left_columns, "l").join(side(right, right_bucket, right_columns, "r"), key, "full")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")), F.lit(n))
                                        for n in left_columns)))
    told = (F.when(F.col("r").isNull(), "left only").when(F.col("l").isNull(), "right only").otherwise("both"))
    return both.select(key, told.alias("side"), F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), F.array_join(
        changed, ",")).alias("columns")).filter("side <> 'both' or columns <> ''")
