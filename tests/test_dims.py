"""History-keeping dimensions: properties over successive snapshots, and the as-of lookup."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlake.functions.keys import numbered
from courierlake.operators import dims

ATTRIBUTES = "driver_id string, name string, phone string, vehicle_type string, rating double, is_active boolean"


def snapshot(spark, rows):
    full = [(k, name, None, vehicle, 4.0, True) for k, name, vehicle in rows]
    return (spark.createDataFrame(full, ATTRIBUTES)
            .withColumn("ingest_timestamp", F.lit("2024-01-01").cast("timestamp")))


def history(spark, *loads):
    dim = None
    for i, rows in enumerate(loads):
        as_of = f"2024-01-{i + 1:02d}"
        dim = dims.refresh_dimension(dim, snapshot(spark, rows), dims.DRIVERS, as_of)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    return dim


def versions(dim, key):
    return [(r.name, r.vehicle_type, r.record_start_date.day, r.record_end_date, r.is_current)
            for r in dim.filter(F.col("driver_id") == key).orderBy("record_start_date", "record_end_date").collect()]


OPEN = date(9999, 12, 31)


def test_two_changes_keep_all_history(spark):
    dim = history(spark, [("a", "Ann", "car")], [("a", "Anna", "car")], [("a", "Anna", "van")])
    assert versions(dim, "a") == [
        ("Ann", "car", 1, date(2024, 1, 2), False), ("Anna", "car", 2, date(2024, 1, 3), False),
        ("Anna", "van", 3, OPEN, True)]


def test_null_counts_as_a_change(spark):
    dim = history(spark, [("a", "Ann", None)], [("a", "Ann", "car")], [("a", "Ann", None)])
    assert [v[1] for v in versions(dim, "a")] == [None, "car", None]


def test_untracked_change_opens_no_version(spark):
    first = snapshot(spark, [("a", "Ann", "car")])
    dim = dims.first_load(first, dims.DRIVERS, "2024-01-01")
    again = dims.scd2(dim, first.withColumn("phone", F.lit("new")), dims.DRIVERS, "2024-01-02")
    assert again.count() == 1 and again.first().phone is None


def test_key_missing_from_snapshot_stays_current(spark):
    dim = history(spark, [("a", "Ann", "car"), ("b", "Bob", "car")], [("a", "Ann", "car")])
    assert versions(dim, "b") == [("Bob", "car", 1, OPEN, True)]


def test_new_key_appears(spark):
    dim = history(spark, [("a", "Ann", "car")], [("a", "Ann", "car"), ("b", "Bob", "van")])
    assert versions(dim, "b") == [("Bob", "van", 2, OPEN, True)]


def test_empty_first_load_then_rows(spark):
    dim = history(spark, [], [("a", "Ann", "car")])
    assert versions(dim, "a") == [("Ann", "car", 2, OPEN, True)]


ROWS = st.dictionaries(st.sampled_from("abcde"), st.tuples(st.sampled_from(["x", "y"]),
                                                           st.sampled_from(["car", None])), max_size=5)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(ROWS, min_size=2, max_size=3))
def test_history_properties(spark, loads):
    loads = [[(k, *v) for k, v in rows.items()] for rows in loads]
    before = 0
    for upto in range(1, len(loads) + 1):
        dim = history(spark, *loads[:upto])
        rows = dim.collect()
        assert len(rows) >= before
        before = len(rows)
    assert len({r.driver_key for r in rows}) == len(rows)
    by_key = {}
    for r in rows:
        by_key.setdefault(r.driver_id, []).append(r)
    for mine in by_key.values():
        assert sum(r.is_current for r in mine) == 1
        mine.sort(key=lambda r: r.record_start_date)
        assert all(a.record_end_date <= b.record_start_date for a, b in zip(mine, mine[1:]))
    again = dims.scd2(dim, snapshot(spark, loads[-1]), dims.DRIVERS, "2024-02-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_numbers_are_unique_and_do_not_depend_on_layout(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a = numbered(df.repartition(7), "k", "n").collect()
    b = numbered(df.coalesce(1), "k", "n").collect()
    assert sorted(a) == sorted(b) and len({r.n for r in a}) == 5000 and min(r.n for r in a) >= 1


def lookup(spark, facts, rows, **bounds):
    hist = spark.createDataFrame(rows, "driver_id string, driver_key bigint, record_start_date string, "
                                       "record_end_date string").withColumns(
        {c: F.col(c).cast("date") for c in ("record_start_date", "record_end_date")})
    f = spark.createDataFrame(facts, "n int, driver_id string, day string")
    out = dims.lookup_as_of(f, hist, dims.DRIVERS, F.col("day").cast("date"), **bounds)
    assert out.columns == ["n", "driver_id", "day", "driver_key"]
    return {r.n: r.driver_key for r in out.collect()}


HISTORY = [("a", 1, "2024-01-10", "2024-01-20"), ("a", 2, "2024-01-20", "2024-03-05"),
           ("a", 3, "2024-03-05", "2024-03-05"), ("a", 4, "2024-03-05", "9999-12-31"),
           ("b", 5, "2024-02-01", "9999-12-31")]
FACTS = [(1, "a", "2024-01-09"), (2, "a", "2024-01-10"), (3, "a", "2024-01-19"), (4, "a", "2024-01-20"),
         (5, "a", "2024-03-04"), (6, "a", "2024-03-05"), (7, "a", "2031-01-01"), (8, "b", "2024-01-31"),
         (9, "b", "2024-02-01"), (10, "c", "2024-02-01"), (11, None, "2024-02-01"), (12, "a", None)]
WANT = {1: None, 2: 1, 3: 1, 4: 2, 5: 2, 6: 4, 7: 4, 8: None, 9: 5, 10: None, 11: None, 12: None}


@pytest.mark.parametrize("slice_by", ["MM", "DD", "YEAR"])
def test_as_of_lookup_does_not_depend_on_its_slices(spark, slice_by):
    assert lookup(spark, FACTS, HISTORY, slice_by=slice_by) == WANT
    assert lookup(spark, FACTS, HISTORY, slice_by=slice_by, backdate=True) == {**WANT, 1: 1, 8: 5}


def test_as_of_lookup_against_all_versions(spark):
    rng = random.Random(2)
    day = date(2024, 1, 1)
    versions_ = []
    for key in "abc":
        cuts = sorted(rng.sample(range(400), 12))
        versions_ += [(key, len(versions_) + n, str(day + timedelta(a)), str(day + timedelta(b)))
                      for n, (a, b) in enumerate(zip(cuts, cuts[1:])) if rng.random() < 0.8]
    asked = [(n, rng.choice("aaaaabcd"), str(day + timedelta(rng.randrange(450)))) for n in range(600)]
    want = {n: next((v[1] for v in versions_ if v[0] == k and v[2] <= d < v[3]), None) for n, k, d in asked}
    assert lookup(spark, asked, versions_) == want
    plan = dims.lookup_as_of(spark.createDataFrame(asked, "n int, driver_id string, day string"), spark.createDataFrame(versions_, "driver_id string, driver_key bigint, record_start_date "
        "string, record_end_date string").withColumns({c: F.col(c).cast("date") for c in (
            "record_start_date", "record_end_date")}), dims.DRIVERS, F.col("day").cast("date"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "explode" not in text.lower()


LOADS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 6), st.sampled_from(["x", "y"]),
                           st.sampled_from(["car", None])), min_size=1, max_size=9, unique_by=lambda r: r[:2])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=LOADS, data=st.data())
def test_history_of_loads_in_any_order(spark, loads, data):
    """Equal to one scd2 after the other by time, whatever the order of the rows; intervals never invert."""
    def built(rows):
        frame = spark.createDataFrame(
            [(k, n, None, v, None, True, datetime(2024, 1, 1), datetime(2024, 1, 1 + d)) for k, d, n, v in rows],
            "driver_id string, name string, phone string, vehicle_type string, rating double, is_active boolean, "
            "ingest_timestamp timestamp, loaded_at timestamp")
        return sorted((r.driver_id, r.record_start_date, r.record_end_date, r.name, r.vehicle_type or "", r.is_current,
                       r.driver_key) for r in dims.history_of(frame, dims.DRIVERS).collect())

    got = built(loads)
    assert built(data.draw(st.permutations(loads))) == got
    want = []
    for key in sorted({r[0] for r in loads}):
        mine = sorted((d, n, v or "") for k, d, n, v in loads if k == key)
        kept = [m for i, m in enumerate(mine) if not i or mine[i - 1][1:] != m[1:]]
        for i, (d, n, v) in enumerate(kept):
            until = date(2024, 1, 1 + kept[i + 1][0]) if i + 1 < len(kept) else date(9999, 12, 31)
            want.append((key, date(2024, 1, 1 + d), until, n, v, i + 1 == len(kept)))
    assert [g[:6] for g in got] == sorted(want)
    assert all(g[1] < g[2] for g in got) and len({g[6] for g in got}) == len(got)


def test_older_snapshot_is_refused(spark):
    dim = dims.first_load(snapshot(spark, [("a", "Ann", "car")]), dims.DRIVERS, "2024-02-01")
    with pytest.raises(Exception, match="older than a current version"):
        dims.scd2(dim, snapshot(spark, [("a", "Ann", "van")]), dims.DRIVERS, "2024-01-01").collect()


def test_calendar(spark):
    days = {r.full_date: r for r in dims.dim_date(spark, *dims.calendar_span("2024-01-01")).collect()}
    assert len(days) == 1461
    monday, sunday = days[date(2024, 1, 1)], days[date(2024, 1, 7)]
    assert (monday.date_key, monday.week, monday.day_of_week, monday.day_name, monday.is_weekend) == (
        20240101, 1, 1, "Monday", False)
    assert (sunday.day_of_week, sunday.is_weekend, sunday.month_name) == (7, True, "January")
    assert days[date(2023, 1, 1)].week == 52


def test_calendar_length_is_bounded(spark):
    with pytest.raises(Exception, match="calendar longer"):
        dims.dim_date(spark, "0001-01-01", "9999-12-31").count()
