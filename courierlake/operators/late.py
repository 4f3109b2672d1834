"""Late arrival: classification, end-of-day confirmations, impact."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.operators.merge import dedup_latest, upsert
from courierlake.operators.rules import INCOMPLETE_STATUSES

# Minutes still on time, hours still accepted.
ON_TIME_MINUTES = 30
ACCEPTED_HOURS = 48


def recent(df: DataFrame, ts: str, as_of, lookback: str = f"{ON_TIME_MINUTES} MINUTES") -> DataFrame:
    """Rows whose time lies within `lookback` of as_of; the filter reaches the scan."""
    return df.filter(S.within(F.col(ts), as_of, lookback))


def classify_lateness(df: DataFrame, event: str, arrival: str, on_time_minutes: int = ON_TIME_MINUTES,
                      accepted_hours: int = ACCEPTED_HOURS) -> DataFrame:
    late = S.minutes_between(F.col(arrival), F.col(event))
    label = (F.when(late.isNull(), F.lit(None))
             .when(late <= on_time_minutes, F.lit("OK"))
             .when(late <= accepted_hours * 60, F.lit("Warning"))
             .otherwise(F.lit("Critical")))
    return df.withColumn("lateness_minutes", late).withColumn("lateness", label)


def late_arrivals(df: DataFrame, event: str, arrival: str, as_of,
                  lookback: str = f"{ON_TIME_MINUTES} MINUTES") -> DataFrame:
    """Records that arrived within `lookback` of as_of, later than on time but still accepted."""
    arrived = recent(df, arrival, as_of, lookback)
    return classify_lateness(arrived, event, arrival).filter("lateness = 'Warning'")


def lateness_summary(classified: DataFrame) -> DataFrame:
    return classified.groupBy("lateness").agg(
        F.count(F.lit(1)).alias("records"),
        F.max("lateness_minutes").alias("max_lateness_minutes"),
        X.mean_minutes(F.col("lateness_minutes")).alias("avg_lateness_minutes"),
    )


def incomplete_orders(orders: DataFrame, limit: int | None = None) -> DataFrame:
    """Orders still under way; with `limit`, the oldest of them."""
    open_orders = orders.filter(F.col("status").isin(INCOMPLETE_STATUSES))
    if limit is None:
        return open_orders
    return open_orders.orderBy("order_time", "order_id").limit(limit)


def delivery_reports(open_orders: DataFrame, as_of) -> DataFrame:
    """End-of-day reports for orders under way: delivered, as of now."""
    return open_orders.select(
        "order_id", F.lit("delivered").alias("status"), S.instant(as_of).alias("delivery_time"))


def apply_confirmations(orders: DataFrame, reports: DataFrame) -> DataFrame:
    """Orders with status and delivery time from the latest report on each."""
    latest = dedup_latest(reports, ["order_id"], ["delivery_time", "status"])
    return upsert(orders, latest, ["order_id"], ["status", "delivery_time"])


def touched_dates(late_rows: DataFrame, ts: str, as_of) -> DataFrame:
    """The report days that late rows fall on, as the cleaning step dates them."""
    return late_rows.select(F.to_date(S.clamp_future(F.col(ts), as_of)).alias("report_date")).distinct()


def impact_report(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  measures: Sequence[str]) -> DataFrame:
    """What late rows changed: both values and the difference of each measure, for changed keys only.

    Differences are taken on decimals, so equal amounts differ by exactly zero.
    """
    keys = list(keys)
    b = before.select(*keys, F.struct(*measures).alias("b"))
    a = after.select(*keys, F.struct(*measures).alias("a"))
    both = b.join(a, keys, "full")

    def delta(m: str) -> Column:
        old, new = F.coalesce(F.col("b")[m], F.lit(0)), F.coalesce(F.col("a")[m], F.lit(0))
        return (X.exact(new) - X.exact(old)).cast("double")

    changed = F.lit(False)
    for m in measures:
        changed = changed | ~F.col("b")[m].eqNullSafe(F.col("a")[m])
    return both.filter(changed).select(
        *keys,
        *[c for m in measures for c in (
            F.col("b")[m].alias(f"{m}_before"), F.col("a")[m].alias(f"{m}_after"),
            delta(m).alias(f"{m}_delta"))],
    )
