"""Distinct customers over any period from mergeable sketches.

An exact distinct count can't be added up: a month needs all orders of the month again. A HyperLogLog sketch per day
and restaurant is a few kilobytes at most, sketches of days unite to those of months or years, and the estimate of a
union is as good as one made from the orders. With 2 ** LG_REGISTERS registers its standard error is under 1 %.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X

LG_REGISTERS = 14
RELATIVE_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)


def customer_sketches(orders: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day and restaurant: a sketch of the customers, orders and revenue."""
    when = F.to_date("order_time") if day is None else day
    return orders.groupBy(when.alias("day"), "restaurant_id").agg(
        F.hll_sketch_agg("customer_id", LG_REGISTERS).alias("customers_sketch"),
        F.count(F.lit(1)).alias("orders"), X.sum_money(F.col("total_amount")).alias("revenue"))


def distinct_customers(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Estimated customers, orders and revenue of groups of stored sketches; no order is read again."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers_sketch")).alias("customers"),
        F.sum("orders").alias("orders"), X.sum_money(F.col("revenue")).alias("revenue"))
