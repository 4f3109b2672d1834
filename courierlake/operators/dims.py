"""Calendar, slowly changing dimensions and their as-of lookup."""

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courierlake.functions import scalars as S
from courierlake.functions.keys import numbered
from courierlake.schemas import GOLD_COLUMNS

# No calendar is longer; 100,000 days are 273 years.
MAX_CALENDAR_DAYS = 100_000
OPEN_END = "9999-12-31"


def calendar_span(as_of, days_back: int = 730, days_ahead: int = 730) -> tuple[str, str]:
    today = date.fromisoformat(str(as_of)[:10])
    return str(today - timedelta(days=days_back)), str(today + timedelta(days=days_ahead))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from start to end, both included."""
    return calendar_of(spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start_date"), F.lit(str(end)).cast("date").alias("end_date")))


def calendar_of(bounds: DataFrame) -> DataFrame:
    """Calendar for a one-row frame (start_date, end_date), such as the min and max of a fact column."""
    start, end = F.col("start_date"), F.col("end_date")
    too_long = F.datediff(end, start) >= MAX_CALENDAR_DAYS
    checked = F.when(too_long, F.raise_error(F.lit(f"calendar longer than {MAX_CALENDAR_DAYS} days"))
                     .cast("date")).otherwise(end)
    days = bounds.select(F.explode(F.sequence(start, checked, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return days.select(
        S.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        weekday.alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def distinct_days(days: DataFrame) -> list[date]:
    """The days in a one-column frame, for partition pruning; refuses more than a calendar holds."""
    found = [r[0] for r in days.distinct().limit(MAX_CALENDAR_DAYS + 1).collect() if r[0] is not None]
    if len(found) > MAX_CALENDAR_DAYS:
        raise ValueError(f"more than {MAX_CALENDAR_DAYS} days")
    return sorted(found)


@dataclass(frozen=True)
class HistorySpec:
    """A history-keeping dimension: its key, its surrogate key, and which changes open a new version."""
    table: str
    key: str
    surrogate: str
    tracked: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return GOLD_COLUMNS[self.table]

    @property
    def attributes(self) -> list[str]:
        history = {self.key, self.surrogate, "record_start_date", "record_end_date", "is_current", "updated_at"}
        return [c for c in self.columns if c not in history]


DRIVERS = HistorySpec("dim_drivers", "driver_id", "driver_key", ("name", "vehicle_type"))
RESTAURANTS = HistorySpec("dim_restaurants", "restaurant_id", "restaurant_key",
                          ("restaurant_name", "cuisine_type", "address", "is_active"))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def first_load(snapshot: DataFrame, spec: HistorySpec, as_of) -> DataFrame:
    now = S.instant(as_of)
    return numbered(snapshot, spec.key, spec.surrogate).withColumns({
        "record_start_date": F.to_date(now),
        "record_end_date": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
        "updated_at": now,
    }).select(*spec.columns)


def scd2(existing: DataFrame, snapshot: DataFrame, spec: HistorySpec, as_of) -> DataFrame:
    """The dimension after one more snapshot (one row per key).

    Current rows meet the snapshot in one full outer join on the key, and each
    pair becomes one or two rows: the old version kept or closed, and a new one
    where a tracked column changed (null counts as a value) or the key is new.
    Intervals are [start, end). Keys missing from the snapshot stay current;
    closed versions pass through untouched.
    """
    now, today = S.instant(as_of), F.to_date(S.instant(as_of))
    old_cols = [c for c in spec.columns if c != spec.key]
    old = current(existing).select(spec.key, F.struct(*old_cols).alias("old"))
    new = snapshot.select(spec.key, F.struct(*spec.attributes).alias("new"))
    pairs = old.join(new, spec.key, "full")

    same = F.lit(True)
    for c in spec.tracked:
        same = same & F.col("old")[c].eqNullSafe(F.col("new")[c])

    def row(overrides: dict[str, Column], source: str, flag: bool) -> Column:
        fields = [overrides.get(c, F.col(source)[c] if c != spec.key else F.col(c)).alias(c)
                  for c in spec.columns]
        return F.struct(*fields, F.lit(flag).alias("_fresh"))

    kept = row({}, "old", False)
    # An older snapshot would end a version before it starts; `history_of` takes loads in any order.
    end = F.when(F.col("old.record_start_date") <= today, today).otherwise(F.raise_error(F.lit(
        f"{spec.table}: a snapshot of {as_of} is older than a current version")).cast("date"))
    closed = row({"record_end_date": end, "is_current": F.lit(False), "updated_at": now}, "old", False)
    opened = row({
        spec.surrogate: F.lit(None).cast("bigint"),
        "record_start_date": today,
        "record_end_date": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
        "updated_at": now,
    }, "new", True)
    versions = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull() | same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    rows = pairs.select(F.inline(versions))
    last_key = existing.agg(F.max(spec.surrogate)).scalar()
    keyed = numbered(rows, spec.key, spec.surrogate, after=last_key, only=F.col("_fresh"))
    closed_before = existing.filter(~F.col("is_current"))
    return closed_before.select(*spec.columns).unionByName(keyed.select(*spec.columns))


def refresh_dimension(existing: DataFrame | None, snapshot: DataFrame, spec: HistorySpec, as_of) -> DataFrame:
    if existing is None:
        return first_load(snapshot, spec, as_of)
    return scd2(existing, snapshot, spec, as_of)


def lookup_as_of(facts: DataFrame, history: DataFrame, spec: HistorySpec, day: Column,
                 slice_by: str = "MM", backdate: bool = False) -> DataFrame:
    """Facts with the surrogate key of the version valid on `day` (start <= day < end), else null.

    Versions and facts of a key are laid in one order by time and the last version is carried forward, so no fact meets
    all versions of its key. A key's time is cut into slices (months, or "DD" for days) that are sorted apart, which
    spreads a hot key; each slice that holds facts starts with the version that was valid before it. With `backdate`
    the first version of a key also stands for the days before it. A zero-length version never matches; facts without
    key or day get null.
    """
    key, surrogate = spec.key, spec.surrogate
    valid = history.filter("record_start_date < record_end_date").select(
        F.col(key).alias("_key"), F.col("record_start_date").alias("_from"),
        F.struct(F.col(surrogate).alias("key"), F.col("record_end_date").alias("end")).alias("_version"))
    if backdate:
        first = F.row_number().over(Window.partitionBy("_key").orderBy("_from")) == 1
        valid = valid.withColumn("_from", F.when(first, F.lit("0001-01-01").cast("date")).otherwise(F.col("_from")))
    dated = facts.withColumn("_day", day).withColumn("_key", F.col(key)).withColumn("_slice", F.trunc("_day", slice_by)
                                                                                     if slice_by != "DD" else F.col("_day"))
    # What was valid before a slice: the last version among those that start earlier, over slices that have facts.
    starts = dated.select("_key", F.col("_slice").alias("_from")).dropna().distinct()
    none = F.lit(None).cast(valid.schema["_version"].dataType)
    ordered = Window.partitionBy("_key").orderBy("_from", F.col("_opens").desc())
    carried = (valid.withColumn("_opens", F.lit(False)).unionByName(
        starts.withColumns({"_version": none, "_opens": F.lit(True)}))
        .withColumn("_version", F.last("_version", ignorenulls=True).over(ordered))
        .filter("_opens and _version is not null").select("_key", "_from", "_version"))
    slice_of = F.col("_from") if slice_by == "DD" else F.trunc("_from", slice_by)
    opened = carried.unionByName(valid).select("_key", slice_of.alias("_slice"), F.col("_from").alias("_day"),
                                               "_version")
    rows = dated.select("_key", "_slice", "_day", none.alias("_version"), F.struct(*facts.columns).alias("_row"))
    blank = F.lit(None).cast(rows.schema["_row"].dataType)
    both = opened.withColumn("_row", blank).unionByName(rows)
    before = Window.partitionBy("_key", "_slice").orderBy("_day", F.col("_row").isNotNull(), F.col("_version.end"))
    found = both.withColumn("_version", F.last("_version", ignorenulls=True).over(before)).filter("_row is not null")
    known = F.col("_key").isNotNull() & (F.col("_day") < F.col("_version.end"))
    return found.select(*(F.col(f"_row.`{c}`").alias(c) for c in facts.columns),
                        F.when(known, F.col("_version.key")).alias(surrogate))


def history_of(snapshots: DataFrame, spec: HistorySpec, loaded: str = "loaded_at") -> DataFrame:
    """The dimension from all its snapshots at once: rows of (key, attributes, `loaded`), loaded in any order.

    Per key, loads in a row that agree in the tracked columns are one version, which keeps the attributes of its first
    load and ends where the next one starts; of several loads on one day the last counts. The result depends on the
    rows and not on the order in which they came, so intervals are never inverted and never overlap.
    """
    day = F.to_date(loaded)
    tracked = F.struct(*spec.tracked)
    # One row per key and day: the last load, ties by content.
    newest = Window.partitionBy(spec.key, day).orderBy(F.col(loaded).desc(), *(F.col(c).desc_nulls_last()
                                                                                for c in spec.attributes))
    daily = snapshots.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place")
    by_time = Window.partitionBy(spec.key).orderBy(loaded)
    islands = (daily.withColumn("_before", F.lag(tracked).over(by_time))
               .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(tracked)))
    end = F.lead(F.col(loaded)).over(by_time)
    versions = islands.withColumn("_next", end).withColumns({
        "record_start_date": day,
        "record_end_date": F.coalesce(F.to_date("_next"), F.lit(OPEN_END).cast("date")),
        "is_current": F.col("_next").isNull(),
        "updated_at": F.coalesce("_next", F.col(loaded)),
        "_name": F.concat_ws("|", F.col(spec.key), day)})
    return numbered(versions, "_name", spec.surrogate).select(*spec.columns)


def dim_menu_items(menu_items: DataFrame) -> DataFrame:
    return (numbered(menu_items, "item_id", "menu_item_key")
            .withColumn("active_flag", F.lit(True))
            .select(*GOLD_COLUMNS["dim_menu_items"]))
