"""Sums and means that do not depend on the order of rows.

A sum of doubles changes with partition layout, and a mean that ends in an exact
half then rounds either way. Amounts are therefore summed as decimals with six
places, which hold 10^26 rows of a million each, and rounded after the sum;
ratings and minutes have a smallest unit and are summed as whole numbers of it.
"""

from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest(x: Column) -> Column:
    """The nearest whole number, halves away from zero. Spark's `round` goes through decimals
    and takes twice the time of the whole sum."""
    return F.when(x < 0, -F.floor(F.lit(0.5) - x)).otherwise(F.floor(x + 0.5))


def cents(col: Column) -> Column:
    return nearest(col * 100)


def exact(col: Column) -> Column:
    """An amount as a decimal with six places; null where it is not a number."""
    return col.try_cast("decimal(28,6)")


def sum_exact(col: Column) -> Column:
    return F.sum(exact(col))


def money(total: Column) -> Column:
    """An exact total in cents precision."""
    return F.round(total, 2).cast("double")


def tenths(col: Column) -> Column:
    return nearest(col * 10)


def whole_seconds(minutes: Column) -> Column:
    """Minutes made from whole seconds, back to whole seconds."""
    return nearest(minutes * 60)


def rounded_ratio(total: Column, count: Column, unit: int, digits: int) -> Column:
    """total / (count * unit), rounded half away from zero to `digits` decimals.

    `count` is a whole number and `total` one or a decimal; the rounding is done on
    them, only the last step makes a double. Null when nothing was counted.
    """
    scale = 10**digits
    common = gcd(unit, scale)
    parts = F.abs(total) * (2 * scale // common)
    whole = F.nullif(count, F.lit(0).cast("bigint")) * (unit // common)
    rounded = F.call_function("div", parts + whole, whole * 2)
    return F.when(total < 0, -rounded).otherwise(rounded) / F.lit(float(scale))


def sum_money(col: Column) -> Column:
    return money(sum_exact(col))


def mean_money(col: Column) -> Column:
    return rounded_ratio(sum_exact(col), F.count(exact(col)), 1, 2)


def mean_minutes(col: Column) -> Column:
    return rounded_ratio(F.sum(whole_seconds(col)), F.count(col), 60, 1)


def mean_rating(col: Column, digits: int = 1) -> Column:
    return rounded_ratio(F.sum(tenths(col)), F.count(col), 10, digits)


def share(part: Column, whole: Column, digits: int) -> Column:
    """part / whole as a fraction."""
    return rounded_ratio(part.cast("bigint"), whole.cast("bigint"), 1, digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return rounded_ratio(part.cast("bigint") * 100, whole.cast("bigint"), 1, digits)
