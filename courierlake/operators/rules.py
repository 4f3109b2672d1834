"""Row rules as data: one list yields the clean rows, the rejected rows and the metrics.

Each rule is a plain predicate, so the conjunction of a list reaches the Parquet
scan as pushed filters.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The states an order may be in.
ORDER_STATUSES = ["placed", "confirmed", "preparing", "ready", "picked_up", "delivered", "cancelled"]
INCOMPLETE_STATUSES = ["picked_up", "ready", "preparing"]
RATING_RANGE = (1.0, 5.0)
TEMPERATURE_RANGE = (-50.0, 60.0)


@dataclass(frozen=True)
class Rule:
    name: str
    passes: Column


def required(*cols: str) -> list[Rule]:
    return [Rule(f"{c} is missing", F.col(c).isNotNull()) for c in cols]


def in_domain(col: str, values: Sequence) -> Rule:
    return Rule(f"{col} is unknown", F.col(col).isin(list(values)))


def positive(col: str) -> Rule:
    return Rule(f"{col} is not positive", F.col(col) > 0)


def in_range(col: str, low: float, high: float) -> Rule:
    return Rule(f"{col} is out of range", F.col(col).between(low, high))


def order_rules() -> list[Rule]:
    return [*required("order_id", "customer_id", "restaurant_id", "order_time"),
            in_domain("status", ORDER_STATUSES)]


def order_item_rules() -> list[Rule]:
    # the whole-number quantity is what must be positive: 0.5 is no item
    whole = Rule("quantity is not positive", F.coalesce(F.col("quantity").try_cast("int"), F.lit(0)) > 0)
    # and the price as it is stored: 0.004 becomes nothing
    priced = Rule("item_price is not positive", F.round("item_price", 2) > 0)
    return [*required("order_item_id", "order_id", "item_id"), whole, priced]


def menu_item_rules() -> list[Rule]:
    return [*required("item_id", "restaurant_id", "name"), positive("price")]


def driver_rules() -> list[Rule]:
    return required("driver_id", "name")


def restaurant_rules() -> list[Rule]:
    return required("restaurant_id", "name")


def rating_rules() -> list[Rule]:
    return [*required("rating_id", "order_id"), *rating_bounds()]


def rating_bounds() -> list[Rule]:
    return [in_range(c, *RATING_RANGE) for c in ("driver_rating", "food_rating", "delivery_rating")]


def weather_rules() -> list[Rule]:
    return [*required("date"), in_range("temperature_celsius", *TEMPERATURE_RANGE)]


def location_rules() -> list[Rule]:
    return required("location_id", "driver_id")


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(reduce(and_, [r.passes for r in rules]))


def rejected(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows `keep` drops, with the names of the rules each one broke."""
    broken = F.array_compact(F.array(
        *[F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.name)) for r in rules]))
    return df.withColumn("reasons", broken).filter(F.size("reasons") > 0)


def quality_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows seen and rows breaking each rule, and any rule, in one pass over the data.

    A row counts against a rule only when the rule is false: a missing value is
    for `required` to report, not for a range.
    """
    breaks = [(r.name, F.coalesce(~r.passes, F.lit(False))) for r in rules]
    breaks.append(("any rule", reduce(lambda a, b: a | b, [b for _, b in breaks])))
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.array(*[
            F.struct(F.lit(name).alias("rule"), F.count_if(broken).alias("invalid_rows"))
            for name, broken in breaks
        ]).alias("found"),
    )
    return counted.select("total_rows", F.inline("found")).select("rule", "total_rows", "invalid_rows")


class QualityGateError(RuntimeError):
    pass


def gate(metrics: DataFrame, max_rate: float, least: int = 0) -> DataFrame:
    """Raise when any rule fails for more than `max_rate` of the rows, and more than `least`; else hand the metrics on."""
    rate = F.col("invalid_rows") / F.nullif(F.col("total_rows"), F.lit(0).cast("bigint"))
    failed = metrics.filter((rate > max_rate) & (F.col("invalid_rows") > least)).collect()  # one row per rule at most
    if failed:
        found = "; ".join(f"{r.rule}: {r.invalid_rows} of {r.total_rows}" for r in failed)
        raise QualityGateError(found)
    return metrics


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    return (child.filter(F.col(key).isNotNull())
            .join(parent.select(key), key, "left_anti"))


def orphan_metrics(child: DataFrame, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """One row like those of `quality_metrics`: rows with the key set, and those of them without a parent.

    `parent` must hold each key once.
    """
    met = child.filter(F.col(key).isNotNull()).select(key).join(
        parent.select(key, F.lit(True).alias("_known")), key, "left")
    return met.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col("_known").isNull()).alias("invalid_rows"))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def assert_unique(df: DataFrame, *key: str) -> DataFrame:
    """Guard for a dimension before facts are joined to it: a second copy would multiply them."""
    sample = duplicate_keys(df, *key).limit(5).collect()
    if sample:
        raise ValueError(f"key {key} is not unique, for example {[tuple(r) for r in sample]}")
    return df
