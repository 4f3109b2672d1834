"""Lookups of facts in dimensions.

No side is hinted for broadcast. Spark decides by size, from file sizes when
planning and from real shuffle sizes while running; beyond its limit a join is
shuffled, and adaptive execution splits the partitions of hot keys and of null
keys over many tasks (see `session.tune`).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.operators.dims import HistorySpec, current, lookup_as_of


def with_key(facts: DataFrame, dim: DataFrame | None, business_key: str, surrogate: str,
             how: str = "left", unknown_key: int | None = None) -> DataFrame:
    """Facts with the surrogate key of the current version of their dimension row.

    Without a dimension the key column is null: a caller that does not read it
    need not pay for the lookup.
    """
    if dim is None:
        keyed = facts.withColumn(surrogate, F.lit(None).cast("bigint"))
    else:
        rows = current(dim) if "is_current" in dim.columns else dim
        keyed = facts.join(rows.select(business_key, surrogate), business_key, how)
    if unknown_key is not None:
        keyed = keyed.withColumn(surrogate, F.coalesce(surrogate, F.lit(unknown_key).cast("bigint")))
    return keyed


def with_date_key(facts: DataFrame, calendar: DataFrame | None, day: Column, how: str = "left") -> DataFrame:
    if calendar is None:
        return facts.withColumn("date_key", F.lit(None).cast("int"))
    days = calendar.select(F.col("full_date").alias("_full_date"), "date_key")
    return facts.join(days, day == F.col("_full_date"), how).drop("_full_date")


def with_version_key(facts: DataFrame, dim: DataFrame | None, spec: HistorySpec, day: Column | None,
                     how: str = "left") -> DataFrame:
    """`with_key` by the dimension version valid on `day`, or the current one where no day is given.

    Days before a key's first version take that one: a dimension starts with its first load, facts may be older.
    """
    if dim is None or day is None:
        return with_key(facts, dim, spec.key, spec.surrogate, how)
    keyed = lookup_as_of(facts, dim, spec, day, backdate=True)
    return keyed.filter(F.col(spec.surrogate).isNotNull()) if how == "inner" else keyed
