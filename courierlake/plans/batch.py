"""The whole pipeline over a lake: bronze to silver to gold, and the rebuild of single days.

Each table is written once and read back by the steps after it, so a lost
executor repeats one step, not the pipeline.
"""

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import exact as X
from courierlake.functions import scalars as S
from courierlake.operators import clean, daily, dims, facts, late, merge, reports, rules
from courierlake.session import size_shuffles, tune
from courierlake.sources.lake import ARRIVAL, BATCH, Lake

CLEANERS: dict[str, Callable] = {
    "orders": clean.clean_orders,
    "order_items": clean.clean_order_items,
    "menu_items": clean.clean_menu_items,
    "drivers": clean.clean_drivers,
    "restaurants": clean.clean_restaurants,
    "ratings": clean.clean_ratings,
    "weather": clean.clean_weather,
}
STAGE = "bronze_orders_staged"
TOUCHED = "rebuild_orders"  # orders of a rebuild, as they were and as they are
IMPACT_BEFORE = "impact_before"  # orders and revenue of the rebuilt days, as they were
LEDGER = "batches_seen"  # per bronze table, the batches that silver and gold hold
FEW = 20  # broken rows among arrivals that stop no run, whatever their share
MOST_BATCHES = 100_000  # new batches of one run; ten days of a stream that triggers every 10 seconds
KEYS = {"orders": "order_id", "order_items": "order_item_id", "ratings": "rating_id"}
BRONZE_RULES: dict[str, Callable] = {
    "orders": rules.order_rules,
    "order_items": rules.order_item_rules,
    "ratings": rules.rating_rules,
}
CHECKS: dict[str, Callable] = {
    "orders": lambda: rules.required("order_id", "customer_id", "restaurant_id"),
    "order_items": lambda: [rules.positive("quantity"), rules.positive("item_price")],
    "ratings": rules.rating_bounds,
}


def bronze_states(lake: Lake, name: str) -> DataFrame | None:
    """A bronze table with one row per order, line or rating, whatever was delivered again."""
    bronze = lake.read_or_none("bronze", f"bronze_{name}")
    return bronze if bronze is None or name not in KEYS else merge.newest_state(bronze, KEYS[name])


def check_bronze(lake: Lake, as_of, max_rate: float, rows: dict[str, DataFrame] | None = None) -> DataFrame:
    """Metrics of the bronze tables, stored with rejected rows; raises before anything is published.

    A rule fails the gate when more than `max_rate` of its rows break it; rows whose order is unknown count as a rule
    too. `rows` holds the arrivals of an incremental run, which are then judged alone.
    """
    found = None
    for name, make in BRONZE_RULES.items():
        mine = bronze_states(lake, name) if rows is None else rows.get(name)
        if mine is None:
            continue
        metrics = rules.quality_metrics(mine, make())
        if name != "orders" and lake.exists("bronze", "bronze_orders"):
            known = lake.read("bronze", "bronze_orders").select("order_id").distinct()
            metrics = metrics.unionByName(rules.orphan_metrics(mine, known, "order_id", "order_id has no order"))
        named = metrics.select(F.lit(name).alias("table_name"), "rule", "total_rows", "invalid_rows",
                               S.instant(as_of).alias("checked_at"))
        found = named if found is None else found.unionByName(named)
        bad = rules.rejected(mine, make()).withColumn("checked_at", S.instant(as_of))
        if rows is None:
            lake.replace(bad, "bronze", f"rejected_{name}")
        else:
            lake.append_or_create(bad.drop("order_date", "rating_date"), "bronze", f"rejected_arrivals_{name}")
    lake.append_or_create(found.coalesce(1), "bronze", "quality_metrics")
    now = lake.read("bronze", "quality_metrics").filter(F.col("checked_at") == S.instant(as_of))
    return rules.gate(now, max_rate, 0 if rows is None else FEW)


def run_silver(lake: Lake, as_of) -> dict[str, int]:
    written = {}
    for name, cleaner in CLEANERS.items():
        bronze = bronze_states(lake, name)
        if bronze is not None:
            written[name] = lake.replace(cleaner(bronze, as_of), "silver", f"silver_{name}")
    orders, ratings = lake.read("silver", "silver_orders"), lake.read("silver", "silver_ratings")
    for name, step in (("restaurant_performance", daily.restaurant_performance),
                       ("driver_performance", daily.driver_performance)):
        written[name] = lake.replace(step(orders, ratings, as_of), "silver", f"silver_{name}")
    return written


def check_silver(lake: Lake, max_rate: float = 0.0) -> dict[str, DataFrame]:
    """Quality metrics of the silver tables; raises when a rule fails for too many rows."""
    return {
        name: rules.gate(rules.quality_metrics(lake.read("silver", f"silver_{name}"), make()), max_rate)
        for name, make in CHECKS.items()
    }


def run_gold(lake: Lake, as_of, calendar_days: int = 730) -> dict[str, int]:
    def gold(name: str) -> DataFrame:
        return lake.read("gold", name)

    def put(df: DataFrame, name: str) -> None:
        written[name] = lake.replace(df, "gold", name)

    written: dict[str, int] = {}
    put(dims.dim_date(lake.spark, *dims.calendar_span(as_of, calendar_days, calendar_days)), "dim_date")
    for spec, source in ((dims.DRIVERS, "silver_drivers"), (dims.RESTAURANTS, "silver_restaurants")):
        snapshot = rules.assert_unique(lake.read("silver", source), spec.key)
        put(dims.refresh_dimension(lake.read_or_none("gold", spec.table), snapshot, spec, as_of), spec.table)
    put(dims.dim_menu_items(rules.assert_unique(lake.read("silver", "silver_menu_items"), "item_id")),
        "dim_menu_items")

    orders, items, ratings = (lake.read("silver", f"silver_{t}") for t in ("orders", "order_items", "ratings"))
    drivers, restaurants, calendar = gold("dim_drivers"), gold("dim_restaurants"), gold("dim_date")
    put(facts.fact_orders(orders, drivers, restaurants, calendar, dated=True), "fact_orders")
    put(facts.fact_order_items(items, gold("fact_orders"), gold("dim_menu_items"), calendar), "fact_order_items")
    put(facts.fact_ratings(ratings, gold("fact_orders"), drivers, restaurants, calendar, dated=True), "fact_ratings")
    put(facts.fact_restaurant_daily(lake.read("silver", "silver_restaurant_performance"), restaurants, calendar,
                                    facts.items_sold(items, orders), dated=True), "fact_restaurant_daily")
    put(facts.fact_driver_daily(lake.read("silver", "silver_driver_performance"), drivers, calendar, dated=True),
        "fact_driver_daily")
    put(facts.fact_business_summary(gold("fact_orders"), gold("fact_ratings"), drivers, restaurants, calendar,
                                    as_of), "fact_business_summary")
    return written


def run_batch(lake: Lake, as_of, calendar_days: int = 730, max_invalid_rate: float = 0.1) -> dict[str, int]:
    """The bronze gate, silver, gold. Returns the rows written per table."""
    tune(lake.spark)
    size_shuffles(lake.spark, f"{lake.root}/bronze")
    taken = batches_held(lake)
    check_bronze(lake, as_of, max_invalid_rate)
    written = run_silver(lake, as_of)
    check_silver(lake)
    written |= run_gold(lake, as_of, calendar_days)
    lake.replace(taken, "bronze", LEDGER)
    return written


def batches_held(lake: Lake) -> DataFrame:
    """(table_name, batch_id) of the bronze tables that grow; their partition values, as they are now."""
    held = [lake.batches("bronze", f"bronze_{name}").select(F.lit(name).alias("table_name"), BATCH)
            for name in KEYS if lake.exists("bronze", f"bronze_{name}")]
    rows = reduce(DataFrame.unionByName, held).limit(MOST_BATCHES * 100).collect()
    return lake.spark.createDataFrame(rows, f"table_name string, {BATCH} bigint")


def arrivals(lake: Lake) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows of the batches no run has taken in yet, per table, and the ledger with them.

    What counts is the batch and not any time in the rows: a partition of the broker may lag, so arrival times of a
    later batch can lie before those of an earlier one.
    """
    held = batches_held(lake)
    ledger = lake.read_or_none("bronze", LEDGER)
    new = held if ledger is None else held.join(ledger, ["table_name", BATCH], "left_anti")
    ids: dict[str, list[int]] = {}
    for r in new.limit(MOST_BATCHES + 1).collect():
        ids.setdefault(r.table_name, []).append(r[BATCH])
    if sum(map(len, ids.values())) > MOST_BATCHES:
        raise ValueError("too many new batches for one run: run the whole pipeline")
    rows = {name: lake.read("bronze", f"bronze_{name}").filter(F.col(BATCH).isin(mine)) for name, mine in ids.items()}
    return rows, held


def reconcile(lake: Lake, ready_at: int = 5_000) -> DataFrame:
    """Row counts of the order tables in each layer, 0 for a missing one, and whether bronze is ready."""
    wanted = [("bronze", f"bronze_{t}") for t in
              ("orders", "order_items", "ratings", "restaurants", "drivers", "menu_items")]
    wanted += [("silver", "silver_orders"), ("silver", "silver_order_items"),
               ("gold", "fact_orders"), ("gold", "fact_order_items"), ("gold", "fact_ratings")]
    nothing = lake.spark.createDataFrame([], "none string")
    tables = {key: (lake.read_or_none(*key) or nothing) for key in wanted}
    return reports.layer_counts(tables).withColumn("ready", F.col("row_count") >= ready_at)


def catch_up(lake: Lake, as_of, max_invalid_rate: float = 0.1) -> list[date]:
    """Rebuild what orders, lines and ratings of new batches touch, however late they are; equals a full run.

    A line or a rating touches the days of its order and its own. The arrivals pass the quality gate first. Counts by
    lateness are kept per run in `lateness_runs`.
    """
    tune(lake.spark)
    new, ledger = arrivals(lake)
    new = {name: df for name, df in new.items() if not df.isEmpty()}
    if not new:
        lake.replace(ledger, "bronze", LEDGER)
        return []
    check_bronze(lake, as_of, max_invalid_rate, new)
    if "orders" in new:
        timed = late.classify_lateness(new["orders"], "order_time", ARRIVAL)
        summary = late.lateness_summary(timed).withColumn("run_at", S.instant(as_of))
        lake.append_or_create(summary.coalesce(1), "bronze", "lateness_runs")
    days = reprocess(lake, touched_orders(lake, new), as_of, new.get("order_items"), new.get("ratings"))
    lake.replace(ledger, "bronze", LEDGER)
    return days


def touched_orders(lake: Lake, new: dict[str, DataFrame]) -> DataFrame:
    """Bronze orders that came anew, or that a new line or rating belongs to."""
    ids = reduce(DataFrame.union, (df.select("order_id") for df in new.values())).distinct()
    return lake.read("bronze", "bronze_orders").join(ids, "order_id", "left_semi")


def confirm_deliveries(lake: Lake, as_of, limit: int | None = None) -> list[date]:
    """End-of-day reports: orders under way become delivered in bronze, and their days are rebuilt.

    The rewritten days are staged first. Should the driver die while they replace
    the old ones, `finish_confirmation` does that step again from the stage.
    """
    tune(lake.spark)
    bronze = lake.read("bronze", "bronze_orders")
    waiting = late.incomplete_orders(bronze, limit)
    days = dims.distinct_days(waiting.select("order_date"))
    if not days:
        return []
    affected = bronze.filter(F.col("order_date").isin(days))
    lake.replace(late.apply_confirmations(affected, late.delivery_reports(waiting, as_of)), "bronze", STAGE)
    return finish_confirmation(lake, as_of)


def finish_confirmation(lake: Lake, as_of) -> list[date]:
    staged = lake.read("bronze", STAGE)
    lake.replace_days(staged, "bronze", "bronze_orders")
    return reprocess(lake, staged, as_of)


def days_to_rebuild(lake: Lake, late_orders: DataFrame, as_of) -> list[date]:
    """The days on which the late orders fall, those they have stood on so far, and those of orders
    that an earlier run dated to its own day because theirs was still to come."""
    today = F.to_date(S.instant(as_of))
    ids = late_orders.select("order_id").distinct()
    bronze = lake.read("bronze", "bronze_orders").select("order_id", F.least("order_date", today).alias("own"),
                                                         (F.col("order_date") > today).alias("ahead"))
    days = late.touched_dates(late_orders, "order_time", as_of)
    days = days.unionAll(bronze.join(ids, "order_id", "left_semi").select("own"))
    days = days.unionAll(bronze.filter("ahead").select("own"))
    silver = lake.read_or_none("silver", "silver_orders")
    if silver is not None:
        days = days.unionAll(silver.join(ids, "order_id", "left_semi").select("order_date"))
        moved = (silver.filter("order_time = ingest_timestamp").select("order_id", "order_date")
                 .join(bronze, "order_id").filter("own <> order_date"))
        days = days.unionAll(moved.select(F.explode(F.array("own", "order_date"))))
    return dims.distinct_days(days)


def days_of(lake: Lake, layers: list[tuple[str, str]], rows: DataFrame, key: str, day: str) -> DataFrame:
    """All days on which the tables hold a row with a key of `rows`."""
    ids = rows.select(key).distinct()
    held = [lake.read(*t).select(key, day).join(ids, key, "left_semi").select(F.col(day).alias("day"))
            for t in layers if lake.exists(*t)]
    return reduce(DataFrame.union, held)


def reprocess(lake: Lake, late_orders: DataFrame, as_of, late_items: DataFrame | None = None,
              late_ratings: DataFrame | None = None) -> list[date]:
    """Rebuild the days that late bronze orders touch; the same result as a full rebuild.

    `late_orders` needs `order_id` and `order_time` and must already be in bronze, as must late lines and ratings;
    their orders must be among `late_orders`. Lines stand on the day they carry, which is later than today for an
    order dated ahead; ratings may fall on later days and are found by order. Returns the days rebuilt.
    """
    tune(lake.spark)
    if late_items is None and late_ratings is None and late.touched_dates(late_orders, "order_time", as_of).isEmpty():
        return []
    days = days_to_rebuild(lake, late_orders, as_of)
    today = F.to_date(S.instant(as_of))
    bronze_items = lake.read("bronze", "bronze_order_items")
    ahead = dims.distinct_days(bronze_items.filter(F.col("order_date") > today).select("order_date"))
    if late_items is not None:
        ahead += dims.distinct_days(days_of(lake, [("bronze", "bronze_order_items"), ("silver", "silver_order_items")],
                                            late_items, "order_item_id", "order_date"))
    if late_ratings is not None:
        days = sorted({*days, *dims.distinct_days(days_of(
            lake, [("bronze", "bronze_ratings"), ("silver", "silver_ratings")], late_ratings, "rating_id",
            "rating_date"))})
    line_days = sorted({*days, *ahead})

    def of(layer: str, table: str, partition: str, which: list[date] = days) -> DataFrame:
        return lake.read(layer, table).filter(F.col(partition).isin(which))

    def put(df: DataFrame, layer: str, table: str, which: list[date] = days) -> None:
        lake.replace_days(df, layer, table, which)

    before = of("silver", "silver_orders", "order_date").select("order_id")
    lake.replace(before, "silver", TOUCHED)
    lake.replace(day_totals(of("gold", "fact_orders", "order_date")), "gold", IMPACT_BEFORE)
    for name, which in (("orders", days), ("order_items", line_days)):
        bronze = lake.read("bronze", f"bronze_{name}")
        bronze = bronze.filter(F.col("order_date").isin(which) | (F.col("order_date") > today))
        silver = CLEANERS[name](merge.newest_state(bronze, KEYS[name]), as_of)
        put(silver.filter(F.to_date("order_time").isin(which)), "silver", f"silver_{name}", which)

    if late_ratings is not None:
        # every day a rating stood on is among `days`, so its newest state is found there
        states = merge.newest_state(of("bronze", "bronze_ratings", "rating_date"), KEYS["ratings"])
        silver = CLEANERS["ratings"](states, as_of)
        put(silver.filter(F.to_date("rating_time").isin(days)), "silver", "silver_ratings")
    orders = of("silver", "silver_orders", "order_date")
    items = of("silver", "silver_order_items", "order_date", line_days)
    ratings = of("silver", "silver_ratings", "rating_date")
    put(daily.restaurant_performance(orders, ratings, as_of), "silver", "silver_restaurant_performance")
    put(daily.driver_performance(orders, ratings, as_of), "silver", "silver_driver_performance")

    drivers, restaurants = lake.read("gold", "dim_drivers"), lake.read("gold", "dim_restaurants")
    calendar, menu = lake.read("gold", "dim_date"), lake.read("gold", "dim_menu_items")
    put(facts.fact_orders(orders, drivers, restaurants, calendar, dated=True), "gold", "fact_orders")
    fact_orders = of("gold", "fact_orders", "order_date")
    put(facts.fact_order_items(items, fact_orders, menu, calendar), "gold", "fact_order_items", line_days)

    # Ratings of orders that came, changed or went.
    touched = lake.read("silver", TOUCHED).unionAll(orders.select("order_id"))
    if late_ratings is not None:
        touched = touched.unionAll(late_ratings.select("order_id"))
    touched = touched.distinct()
    theirs = lake.read("silver", "silver_ratings").join(touched, "order_id", "left_semi")
    rating_days = dims.distinct_days(theirs.select("rating_date"))
    if late_ratings is not None:
        rating_days = sorted({*rating_days, *days})
    if rating_days:
        old = of("gold", "fact_ratings", "rating_date", rating_days)
        others = old.join(touched, "order_id", "left_anti").drop("rating_date")
        own = facts.fact_ratings(theirs, fact_orders, drivers, restaurants, calendar, dated=True)
        put(others.unionByName(own), "gold", "fact_ratings", rating_days)

    put(facts.fact_restaurant_daily(
        of("silver", "silver_restaurant_performance", "performance_day"), restaurants, calendar,
        facts.items_sold(items, orders), dated=True), "gold", "fact_restaurant_daily")
    put(facts.fact_driver_daily(
        of("silver", "silver_driver_performance", "performance_day"), drivers, calendar, dated=True),
        "gold", "fact_driver_daily")
    put(facts.fact_business_summary(
        fact_orders, of("gold", "fact_ratings", "rating_date"), drivers, restaurants, calendar, as_of),
        "gold", "fact_business_summary")
    impact = late.impact_report(lake.read("gold", IMPACT_BEFORE), day_totals(fact_orders), ["order_date"],
                                ["orders", "revenue"])
    lake.append_or_create(impact.withColumn("rebuilt_at", S.instant(as_of)).coalesce(1), "gold", "late_impact")
    return days


def day_totals(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"),
                                                 X.sum_money(F.col("total_amount")).alias("revenue"))
