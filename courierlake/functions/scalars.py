"""Row-wise expressions of the cleaning and fact steps. All are built-in Catalyst expressions."""

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SLA_MINUTES = 45.0
CANCELLED = "cancelled"


def instant(as_of: str | date | datetime | Column) -> Column:
    """A run's "now" as a timestamp in the session zone; the library never reads the clock."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def clamp_future(ts: Column, as_of) -> Column:
    now = instant(as_of)
    return F.when(ts > now, now).otherwise(ts)


def null_if_before(later: Column, earlier: Column) -> Column:
    return F.when(later < earlier, F.lit(None)).otherwise(later)


def seconds_between(end: Column, start: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(end: Column, start: Column) -> Column:
    """Whole seconds over 60; null when either side is, negative when end comes first."""
    return seconds_between(end, start) / F.lit(60.0)


def money_floor(amount: Column) -> Column:
    return F.when(amount < 0, F.lit(0.0)).otherwise(F.round(amount, 2))


def default_label(col: Column, label: str) -> Column:
    return F.coalesce(F.trim(col), F.lit(label))


def is_cancelled(status: Column) -> Column:
    return status == CANCELLED


def extended_price(quantity: Column, price: Column) -> Column:
    return F.round(quantity * price, 2)


def sla_breached(minutes: Column, sla: float = SLA_MINUTES) -> Column:
    return F.coalesce(minutes > F.lit(float(sla)), F.lit(False))


def display_minutes(minutes: Column) -> Column:
    return minutes.cast("int")


def within(ts: Column, as_of, lookback: str) -> Column:
    """ts no older than `lookback` (an interval such as '1 day') before as_of."""
    return ts >= instant(as_of) - F.expr(f"INTERVAL {lookback}")


# Scores a record gets for the first thing found wrong with it.
SCORE_NO_ORDER = 0.0
SCORE_NO_CUSTOMER = 0.2
SCORE_NO_RESTAURANT = 0.1
SCORE_NO_AMOUNT = 0.3
SCORE_NO_ARRIVAL = 0.4
SCORE_GOOD = 1.0


def quality_score(order_id: Column, customer_id: Column, restaurant_id: Column,
                  amount: Column, arrival: Column) -> Column:
    ladder = [
        (order_id.isNull(), SCORE_NO_ORDER),
        (customer_id.isNull(), SCORE_NO_CUSTOMER),
        (restaurant_id.isNull(), SCORE_NO_RESTAURANT),
        (amount <= 0, SCORE_NO_AMOUNT),
        (arrival.isNull(), SCORE_NO_ARRIVAL),
    ]
    # coalesce of "when" without otherwise keeps the first rung that applies
    return F.coalesce(*[F.when(cond, F.lit(score)) for cond, score in ladder], F.lit(SCORE_GOOD))


def date_key(day: Column) -> Column:
    """yyyymmdd as an int, the same for a day whatever range a calendar covers."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
