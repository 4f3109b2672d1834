"""The registered queries once more, as DuckDB SQL over the same given tables.

Written apart from the DataFrame code: only the mapping of the given tables, the
constants and the rounding rule (whole units, half away from zero) are agreed.
"""

from math import gcd

AS_OF = "TIMESTAMP '2001-07-01 00:00:00'"
FIRST_LOAD = "TIMESTAMP '1995-01-01 00:00:00'"
SECOND_LOAD = "TIMESTAMP '1998-07-01 00:00:00'"
THIRD_LOAD = "TIMESTAMP '2000-02-01 00:00:00'"
# as_of less 3650 and plus 730 days
CALENDAR = (f"CAST({AS_OF} - INTERVAL 3650 DAY AS DATE)", f"CAST({AS_OF} + INTERVAL 730 DAY AS DATE)")
LOOKBACK = f"{AS_OF} - INTERVAL 365 DAY"
OPEN_END = "DATE '9999-12-31'"


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def tenths(x: str) -> str:
    return f"CAST(round(({x}) * 10) AS BIGINT)"


def secs(x: str) -> str:
    return f"CAST(round(({x}) * 60) AS BIGINT)"


def money(x: str) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(28,6))), 2) AS DOUBLE)"


def micros(x: str) -> str:
    return f"sum(CAST(round(({x}) * 1e6) AS HUGEINT))"


def ratio(total: str, count: str, unit: int, digits: int) -> str:
    g = gcd(unit, 10**digits)
    a, u = 2 * 10**digits // g, unit // g
    whole = f"(({count}) * {u})"
    return (f"(CASE WHEN ({total}) < 0 THEN -1 ELSE 1 END"
            f" * ((abs({total}) * {a} + {whole}) // ({whole} * 2)) / 1e{digits})")


def mean_money(x: str) -> str:
    return ratio(micros(x), f"count({x})", 10**6, 2)


def mean_minutes(x: str) -> str:
    return ratio(f"sum({secs(x)})", f"count({x})", 60, 1)


def mean_mark(x: str, digits: int = 1) -> str:
    return ratio(f"sum({tenths(x)})", f"count({x})", 10, digits)


def key(*cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + "))"


def rounded(x: str, digits: int) -> str:
    """Decimal rounding of a double as Spark does it: on its decimal digits."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 9)), {digits}) AS DOUBLE)"


def minutes(end: str, start: str) -> str:
    return f"date_diff('second', {start}, {end}) / 60e0"


def bucket(key: str) -> str:
    digit = "(instr('0123456789abcdef', substr(md5(CAST({k} AS VARCHAR)), {i}, 1)) - 1)"
    return " + ".join(f"{16 ** (3 - i)} * " + digit.format(k=key, i=i) for i in (1, 2, 3))


def number(key: str) -> str:
    return (f"CAST((row_number() OVER (PARTITION BY {bucket(key)} ORDER BY {key}) - 1) * 4096"
            f" + {bucket(key)} + 1 AS BIGINT)")


def date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


STATUSES = "('placed', 'confirmed', 'preparing', 'ready', 'picked_up', 'delivered', 'cancelled')"
REGION_OF = "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"

# name -> (names it reads, query)
STEPS: dict[str, tuple[list[str], str]] = {
    "per_order": ([], """
        SELECT l_orderkey AS order_id, min(l_suppkey) AS restaurant_id, min(l_shipdate) AS delivery_time,
               max(l_shipdate) AS prep_end_time
        FROM lineitem GROUP BY l_orderkey"""),
    "bronze_orders": (["per_order"], f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, restaurant_id, user_id AS driver_id,
               o_orderdate + to_hours(o_orderkey % 24) AS order_time,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'cancelled'
                                  WHEN 'P' THEN 'preparing' END AS status,
               delivery_time, o_totalprice AS total_amount,
               o_orderdate + to_hours(o_orderkey % 24) AS prep_start_time, prep_end_time,
               (({cents('o_totalprice')} * 5 + 50) // 100 - 250000) / 1e2 AS tip_amount
        FROM orders LEFT JOIN per_order ON o_orderkey = order_id LEFT JOIN events ON o_orderkey = event_id"""),
    "bronze_items": ([], """
        SELECT l_orderkey || '_item_' || l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS item_id, l_quantity AS quantity, p_retailprice AS item_price,
               o_orderdate + to_hours(o_orderkey % 24) AS order_time
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""),
    "bronze_ratings": (["bronze_orders"], """
        SELECT event_id AS rating_id, event_id AS order_id, user_id AS driver_id, restaurant_id,
               value / 20 AS driver_rating, value / 25 AS food_rating, value / 30 AS delivery_rating,
               order_time AS rating_time, event_type AS rating_type
        FROM events JOIN bronze_orders ON event_id = order_id"""),
    "silver_orders": (["bronze_orders"], f"""
        SELECT order_id, customer_id, restaurant_id, driver_id, status, placed AS order_time,
               CASE WHEN delivery_time >= placed THEN delivery_time END AS delivery_time,
               CASE WHEN total_amount < 0 THEN 0 ELSE {rounded('total_amount', 2)} END AS total_amount,
               {minutes('prep_end_time', 'prep_start_time')} AS prep_time_minutes,
               CASE WHEN delivery_time >= placed THEN {minutes('delivery_time', 'placed')} END
                   AS delivery_time_minutes,
               CASE WHEN tip_amount < 0 THEN 0 ELSE {rounded('tip_amount', 2)} END AS tip_amount,
               status = 'cancelled' AS cancelled, {AS_OF} AS ingest_timestamp
        FROM (SELECT *, least(order_time, {AS_OF}) AS placed FROM bronze_orders)
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND restaurant_id IS NOT NULL
          AND order_time IS NOT NULL AND status IN {STATUSES}"""),
    "silver_items": (["bronze_items"], f"""
        SELECT order_item_id, order_id, item_id, CAST(quantity AS INTEGER) AS quantity,
               {rounded('item_price', 2)} AS item_price,
               {rounded(f"CAST(quantity AS INTEGER) * {rounded('item_price', 2)}", 2)} AS extended_price,
               order_time, {AS_OF} AS ingest_timestamp
        FROM bronze_items
        WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL AND item_id IS NOT NULL
          AND CAST(quantity AS INTEGER) > 0 AND item_price > 0"""),
    "silver_ratings": (["bronze_ratings"], f"""
        SELECT rating_id, order_id, driver_id, restaurant_id, {rounded('driver_rating', 1)} AS driver_rating,
               {rounded('food_rating', 1)} AS food_rating, {rounded('delivery_rating', 1)} AS delivery_rating,
               rating_time, coalesce(trim(rating_type), 'unknown') AS rating_type, {AS_OF} AS ingest_timestamp
        FROM bronze_ratings
        WHERE driver_rating BETWEEN 1 AND 5 AND food_rating BETWEEN 1 AND 5 AND delivery_rating BETWEEN 1 AND 5"""),
    "silver_restaurants": ([], f"""
        SELECT s_suppkey AS restaurant_id, trim(s_name) AS restaurant_name,
               coalesce(trim(n_name), 'Other') AS cuisine_type, CAST(NULL AS VARCHAR) AS address,
               CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS DOUBLE) AS rating, s_acctbal >= 0 AS is_active,
               {AS_OF} AS ingest_timestamp
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE s_suppkey IS NOT NULL AND s_name IS NOT NULL"""),
    "silver_drivers": ([], f"""
        SELECT c_custkey AS driver_id, trim(c_name) AS name, CAST(NULL AS VARCHAR) AS phone,
               coalesce(trim(c_mktsegment), 'Unknown') AS vehicle_type, CAST(NULL AS DOUBLE) AS rating,
               c_acctbal >= 0 AS is_active, {AS_OF} AS ingest_timestamp
        FROM customer WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL"""),
    "silver_menu_items": ([], f"""
        SELECT p_partkey AS item_id, restaurant_id, trim(p_name) AS item_name,
               coalesce(trim(p_type), 'Other') AS category, {rounded('p_retailprice', 2)} AS base_price,
               {AS_OF} AS ingest_timestamp
        FROM part JOIN (SELECT l_partkey, min(l_suppkey) AS restaurant_id FROM lineitem GROUP BY l_partkey)
             ON p_partkey = l_partkey
        WHERE p_name IS NOT NULL AND p_retailprice > 0 AND restaurant_id IS NOT NULL"""),
    "scored": (["bronze_orders"], f"""
        SELECT order_id, customer_id, restaurant_id, driver_id, status, order_time, delivery_time, total_amount,
               tip_amount, CASE WHEN status <> 'preparing' THEN order_time END AS arrival_time,
               {minutes('prep_end_time', 'prep_start_time')} AS prep_time_minutes,
               {minutes('delivery_time', 'order_time')} AS delivery_time_minutes,
               status = 'cancelled' AS cancelled,
               CASE WHEN customer_id IS NULL THEN 0.2e0 WHEN restaurant_id IS NULL THEN 0.1e0
                    WHEN total_amount <= 0 THEN 0.3e0
                    WHEN status IS NULL OR status = 'preparing' OR order_time IS NULL THEN 0.4e0
                    ELSE 1e0 END AS data_quality_score,
               order_time AS processing_timestamp
        FROM bronze_orders WHERE order_id IS NOT NULL"""),
    "restaurant_performance": (["silver_orders", "silver_ratings"], f"""
        SELECT report_date, restaurant_id, avg_prep_time, coalesce(r.avg_rating, 4) AS avg_rating, orders_count,
               cancel_rate, avg_tip, total_revenue, {AS_OF} AS ingest_timestamp
        FROM (SELECT CAST(order_time AS DATE) AS report_date, restaurant_id,
                     {mean_minutes('prep_time_minutes')} AS avg_prep_time, count(order_id) AS orders_count,
                     {ratio("count(*) FILTER (WHERE cancelled)", 'count(order_id)', 1, 3)} AS cancel_rate,
                     {mean_money('tip_amount')} AS avg_tip, {money('total_amount')} AS total_revenue
              FROM silver_orders GROUP BY ALL)
        LEFT JOIN (SELECT CAST(rating_time AS DATE) AS report_date, restaurant_id,
                          {mean_mark('food_rating')} AS avg_rating
                   FROM silver_ratings GROUP BY ALL) r USING (report_date, restaurant_id)"""),
    "driver_performance": (["silver_orders", "silver_ratings"], f"""
        SELECT report_date, driver_id, coalesce(r.avg_rating, 4) AS avg_rating, orders_completed,
               avg_delivery_time, total_tips, {AS_OF} AS ingest_timestamp
        FROM (SELECT CAST(order_time AS DATE) AS report_date, driver_id, count(order_id) AS orders_completed,
                     {mean_minutes('delivery_time_minutes')} AS avg_delivery_time,
                     {money('tip_amount')} AS total_tips
              FROM silver_orders WHERE driver_id IS NOT NULL GROUP BY ALL)
        LEFT JOIN (SELECT CAST(rating_time AS DATE) AS report_date, driver_id,
                          {mean_mark('driver_rating')} AS avg_rating
                   FROM silver_ratings GROUP BY ALL) r USING (report_date, driver_id)"""),
    "calendar": ([], f"""
        SELECT CAST(d AS DATE) AS full_date, {date_key('d')} AS date_key
        FROM generate_series({CALENDAR[0]}::TIMESTAMP, {CALENDAR[1]}::TIMESTAMP, INTERVAL 1 DAY) s(d)"""),
    "dim_restaurants": (["silver_restaurants"], f"""
        SELECT {number('restaurant_id')} AS restaurant_key, * EXCLUDE (ingest_timestamp),
               CAST({FIRST_LOAD} AS DATE) AS record_start_date, {OPEN_END} AS record_end_date,
               true AS is_current, ingest_timestamp, {FIRST_LOAD} AS updated_at
        FROM silver_restaurants"""),
    "dim_drivers": (["silver_drivers"], f"""
        SELECT {number('driver_id')} AS driver_key, * EXCLUDE (ingest_timestamp),
               CAST({FIRST_LOAD} AS DATE) AS record_start_date, {OPEN_END} AS record_end_date,
               true AS is_current, ingest_timestamp, {FIRST_LOAD} AS updated_at
        FROM silver_drivers"""),
    "dim_menu_items": (["silver_menu_items"], f"""
        SELECT {number('item_id')} AS menu_item_key, item_id, item_name, category, base_price,
               true AS active_flag, ingest_timestamp
        FROM silver_menu_items"""),
    "fact_orders": (["silver_orders", "dim_drivers", "dim_restaurants", "calendar"], f"""
        SELECT {key('o.order_id')} AS order_key, o.order_id, c.date_key, d.driver_key, r.restaurant_key, o.order_time, o.delivery_time, o.status,
               o.total_amount, {rounded('o.delivery_time_minutes', 1)} AS delivery_minutes,
               {rounded('o.prep_time_minutes', 1)} AS prep_time_minutes,
               coalesce(o.delivery_time_minutes > 45, false) AS sla_breached, o.cancelled, o.tip_amount,
               o.ingest_timestamp
        FROM silver_orders o LEFT JOIN dim_drivers d ON o.driver_id = d.driver_id
             LEFT JOIN dim_restaurants r ON o.restaurant_id = r.restaurant_id
             LEFT JOIN calendar c ON CAST(o.order_time AS DATE) = c.full_date"""),
    "fact_items": (["silver_items", "silver_orders", "dim_menu_items", "calendar"], f"""
        SELECT {key('i.order_item_id')} AS order_item_key, {key('i.order_id')} AS order_key, m.menu_item_key, i.quantity, i.item_price, i.extended_price, c.date_key, i.order_time, i.order_id
        FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
             LEFT JOIN dim_menu_items m ON i.item_id = m.item_id
             LEFT JOIN calendar c ON CAST(i.order_time AS DATE) = c.full_date"""),
    "fact_ratings": (["silver_ratings", "silver_orders", "dim_drivers", "dim_restaurants", "calendar"], f"""
        SELECT {key('x.rating_id')} AS rating_key,
               CASE WHEN o.order_id IS NOT NULL THEN {key('o.order_id')} END AS order_key, d.driver_key, r.restaurant_key, x.driver_rating, x.food_rating, x.delivery_rating, x.rating_time,
               x.rating_type, c.date_key, x.order_id
        FROM silver_ratings x LEFT JOIN silver_orders o ON x.order_id = o.order_id LEFT JOIN dim_drivers d ON x.driver_id = d.driver_id
             LEFT JOIN dim_restaurants r ON x.restaurant_id = r.restaurant_id
             LEFT JOIN calendar c ON CAST(x.rating_time AS DATE) = c.full_date"""),
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []
    for n in names:
        for m in [*_closure(STEPS[n][0]), n]:
            if m not in ordered:
                ordered.append(m)
    return ordered


def sql(body: str, *reads: str) -> str:
    """`body` after the steps it reads, as one statement."""
    names = _closure(list(reads))
    if not names:
        return body
    steps = ",\n".join(f"{n} AS ({STEPS[n][1]})" for n in names)
    return f"WITH {steps}\n{body}"


def _whole(step: str) -> str:
    return sql(f"SELECT * FROM {step}", step)


def _scd2(step: str, key: str, surrogate: str, tracked: list[str], carried: list[str], changed: str) -> str:
    """The dimension after a second load, as a union of its kinds of rows. `changed` is the later snapshot."""
    differs = " OR ".join(f"e.{c} IS DISTINCT FROM s.{c}" for c in tracked)
    cols = ", ".join(carried)
    same_cols = ", ".join(f"e.{c}" for c in carried)
    return f"""
        , earlier AS (
            SELECT {number(key)} AS {surrogate}, {key}, {cols}, ingest_timestamp FROM {step} WHERE is_active),
        later AS ({changed}),
        changes AS (SELECT e.{key}, {differs} AS differs FROM earlier e JOIN later s USING ({key})),
        fresh AS (
            SELECT l.* FROM later l LEFT JOIN changes c USING ({key}) WHERE c.{key} IS NULL OR c.differs)
        SELECT e.{surrogate}, e.{key}, {same_cols}, CAST({FIRST_LOAD} AS DATE) AS record_start_date,
               CASE WHEN c.differs THEN CAST({SECOND_LOAD} AS DATE) ELSE {OPEN_END} END AS record_end_date,
               coalesce(NOT c.differs, true) AS is_current, e.ingest_timestamp,
               CASE WHEN c.differs THEN {SECOND_LOAD} ELSE {FIRST_LOAD} END AS updated_at
        FROM earlier e LEFT JOIN changes c USING ({key})
        UNION ALL
        SELECT (SELECT max({surrogate}) FROM earlier) + {number(key)} AS {surrogate}, {key}, {cols},
               CAST({SECOND_LOAD} AS DATE), {OPEN_END}, true, ingest_timestamp, {SECOND_LOAD}
        FROM fresh"""


def _after_steps(body: str, *reads: str) -> str:
    """Like `sql`, for a body that goes on with steps of its own."""
    return sql("", *reads) + body


LATER_RESTAURANTS = f"""
    SELECT restaurant_id, CASE WHEN r_name = 'ASIA' THEN restaurant_name || ' II' ELSE restaurant_name END
               AS restaurant_name, cuisine_type,
           CASE WHEN r_name = 'EUROPE' THEN 'Unit ' || restaurant_id END AS address, phone, rating, is_active,
           ingest_timestamp
    FROM silver_restaurants JOIN ({REGION_OF}) ON cuisine_type = n_name"""
LATER_DRIVERS = """
    SELECT driver_id, name, phone, CASE vehicle_type WHEN 'MACHINERY' THEN 'VAN' WHEN 'BUILDING' THEN NULL
               ELSE vehicle_type END AS vehicle_type, rating, is_active, ingest_timestamp
    FROM silver_drivers"""
SCD2_RESTAURANTS = _scd2(
    "silver_restaurants", "restaurant_id", "restaurant_key",
    ["restaurant_name", "cuisine_type", "address", "is_active"],
    ["restaurant_name", "cuisine_type", "address", "phone", "rating", "is_active"], LATER_RESTAURANTS)
SCD2_DRIVERS = _scd2(
    "silver_drivers", "driver_id", "driver_key", ["name", "vehicle_type"],
    ["name", "phone", "vehicle_type", "rating", "is_active"], LATER_DRIVERS)


LOADED_COLUMNS = ("restaurant_id, restaurant_name, cuisine_type, address, phone, rating, is_active, "
                  "ingest_timestamp")


def _dated(key: str, history: str) -> str:
    """Versions of a history; the first of each key also stands for the days before it."""
    return f"""
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY record_start_date) = 1
                       THEN DATE '0001-01-01' ELSE record_start_date END AS since
        FROM (WITH one AS (SELECT 1) {history}) WHERE record_start_date < record_end_date"""


def _daily_performance(where: str = "true") -> str:
    def mean(x: str) -> str:
        return f"sum({secs(x)}) / (60e0 * count({x}))"

    return sql(f"""
        SELECT CAST(order_time AS DATE) AS performance_date, restaurant_id, driver_id, count(*) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers, {money('total_amount')} AS total_revenue,
               {mean('delivery_time_minutes')} AS avg_delivery_time, {mean('prep_time_minutes')} AS avg_prep_time,
               count(*) FILTER (WHERE cancelled) AS cancelled_orders,
               sum({tenths('data_quality_score')}) / (10e0 * count(data_quality_score)) AS avg_quality_score,
               {AS_OF} AS processing_timestamp
        FROM scored WHERE {where} GROUP BY 1, 2, 3""", "scored")


def _business_summary(period: str, unit: str) -> str:
    marks = f"{tenths('driver_rating')} + {tenths('food_rating')} + {tenths('delivery_rating')}"
    return f"""
        SELECT {key('period_start', f"'{period}'")} AS summary_key, date_key, '{period}' AS time_period, total_orders, total_revenue, avg_order_value,
               (SELECT count(*) FROM silver_drivers) AS active_drivers,
               (SELECT count(*) FROM silver_restaurants) AS active_restaurants,
               coalesce(overall_satisfaction, 4) AS overall_satisfaction, avg_delivery_time, total_tips,
               sla_breach_rate, period_start, {AS_OF} AS ingest_timestamp
        FROM (SELECT date_key, CAST(date_trunc('{unit}', order_time) AS TIMESTAMP) AS period_start,
                     count(*) AS total_orders, {money('total_amount')} AS total_revenue,
                     {mean_money('total_amount')} AS avg_order_value,
                     {mean_mark('delivery_minutes')} AS avg_delivery_time, {money('tip_amount')} AS total_tips,
                     {ratio('count(*) FILTER (WHERE sla_breached)', 'count(*)', 1, 3)} AS sla_breach_rate
              FROM fact_orders WHERE date_key IS NOT NULL GROUP BY 1, 2)
        LEFT JOIN (SELECT date_key, CAST(date_trunc('{unit}', rating_time) AS TIMESTAMP) AS period_start,
                          {ratio(f'sum({marks})', 'count(*)', 30, 2)} AS overall_satisfaction
                   FROM fact_ratings WHERE date_key IS NOT NULL GROUP BY 1, 2) USING (date_key, period_start)"""


def _quality(frm: str, *checks: tuple[str, str]) -> str:
    rows = [(name, f"coalesce({bad}, false)") for name, bad in checks]
    rows.append(("any rule", " OR ".join(bad for _, bad in rows)))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS total_rows, count(*) FILTER (WHERE {bad}) AS invalid_rows FROM {frm}"
        for name, bad in rows)


def _range_rule(col: str) -> tuple[str, str]:
    return f"{col} is out of range", f"{col} NOT BETWEEN 1 AND 5"


MARKS = ("driver_rating", "food_rating", "delivery_rating")
DELIVERED = "status = 'delivered'"
RATED_ORDERS = """
    (SELECT order_id, sum({m}) AS marks, count(*) AS rated FROM silver_ratings GROUP BY order_id)"""
EVENTS_ARRIVED = """
    (SELECT event_id, event_type, ts, ts + to_hours(event_id % 73) AS arrival_time,
            (event_id % 73) * 60e0 AS lateness_minutes,
            CASE WHEN event_id % 73 = 0 THEN 'OK' WHEN event_id % 73 <= 48 THEN 'Warning'
                 ELSE 'Critical' END AS lateness
     FROM events)"""

CONTENT = (f"coalesce(status, '~'), coalesce(CAST({cents('total_amount')} AS VARCHAR), '~'), "
           f"coalesce(CAST({cents('tip_amount')} AS VARCHAR), '~'), CAST(CAST(epoch(order_time) AS BIGINT) AS VARCHAR)")

ORACLE: dict[str, str] = {
    # sources
    "json_decode": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "decode_orders": sql("""
        SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(restaurant_id AS VARCHAR) AS restaurant_id, CAST(driver_id AS VARCHAR) AS driver_id,
               order_time, status, delivery_time, total_amount, prep_start_time, prep_end_time, tip_amount
        FROM bronze_orders""", "bronze_orders"),
    "decode_order_items": sql("""
        SELECT order_item_id, CAST(order_id AS VARCHAR) AS order_id, CAST(item_id AS VARCHAR) AS item_id,
               CAST(quantity AS INTEGER) AS quantity, item_price, order_time
        FROM bronze_items""", "bronze_items"),
    # silver
    "silver_orders": _whole("silver_orders"),
    "silver_order_items": _whole("silver_items"),
    "silver_menu_items": _whole("silver_menu_items"),
    "silver_drivers": _whole("silver_drivers"),
    "silver_restaurants": _whole("silver_restaurants"),
    "silver_ratings": _whole("silver_ratings"),
    "silver_weather": f"""
        SELECT CAST(ts AS DATE) AS date, {rounded(f"({cents('value')} - 6000) / 1e2", 1)} AS temperature_celsius,
               CAST(user_id % 100 AS INTEGER) AS humidity_percent,
               coalesce(trim(event_type), 'Unknown') AS conditions, {rounded('value / 4', 1)} AS wind_speed_kmh,
               {AS_OF} AS ingest_timestamp
        FROM events WHERE ts IS NOT NULL AND value BETWEEN 10 AND 120""",
    "silver_locations": f"""
        SELECT event_id AS location_id, user_id AS driver_id, ts AS event_time, {AS_OF} AS processing_timestamp
        FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL""",
    "restaurant_performance": _whole("restaurant_performance"),
    "driver_performance": _whole("driver_performance"),
    "scored_orders": _whole("scored"),
    "quality_score": sql("""
        SELECT order_id, CASE WHEN customer_id IS NULL THEN 0.2e0 WHEN restaurant_id IS NULL THEN 0.1e0
                              WHEN tip_amount <= 0 THEN 0.3e0 WHEN status = 'preparing' THEN 0.4e0
                              ELSE 1e0 END AS data_quality_score
        FROM bronze_orders""", "bronze_orders"),
    "daily_performance": _daily_performance(),
    "recent_daily_performance": _daily_performance(f"processing_timestamp >= {LOOKBACK}"),
    # dimensions
    "dim_date": f"""
        SELECT {date_key('d')} AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               CAST(weekofyear(d) AS INTEGER) AS week, CAST(isodow(d) AS INTEGER) AS day_of_week,
               monthname(d) AS month_name, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
               false AS is_holiday
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_keys": sql(f"SELECT driver_id, {number('driver_id')} AS driver_key FROM silver_drivers", "silver_drivers"),
    "dim_drivers": _whole("dim_drivers"),
    "dim_restaurants": _whole("dim_restaurants"),
    "dim_menu_items": _whole("dim_menu_items"),
    "scd2_drivers": _after_steps(SCD2_DRIVERS, "silver_drivers"),
    "scd2_restaurants": _after_steps(SCD2_RESTAURANTS, "silver_restaurants"),
    "scd2_as_of": sql(f"""
        SELECT o.order_id, o.restaurant_id, o.order_time, h.restaurant_key
        FROM silver_orders o LEFT JOIN (
            WITH one AS (SELECT 1) {SCD2_RESTAURANTS}) h
          ON o.restaurant_id = h.restaurant_id AND CAST(o.order_time AS DATE) >= h.record_start_date
             AND CAST(o.order_time AS DATE) < h.record_end_date""", "silver_orders", "silver_restaurants"),
    "restaurant_registry": sql("""
        SELECT restaurant_id, row_number() OVER (
            ORDER BY NOT is_active, substr(md5(CAST(restaurant_id AS VARCHAR)), 1, 3), restaurant_id) AS restaurant_key
        FROM silver_restaurants""", "silver_restaurants"),
    "scd2_rebuilt": sql(f"""
        , loads AS (
            SELECT {LOADED_COLUMNS}, {FIRST_LOAD} AS since FROM silver_restaurants WHERE is_active
            UNION ALL SELECT {LOADED_COLUMNS}, {SECOND_LOAD} FROM ({LATER_RESTAURANTS})
            UNION ALL SELECT {LOADED_COLUMNS}, {THIRD_LOAD} FROM silver_restaurants),
        opened AS (
            SELECT * FROM loads a WHERE NOT EXISTS (
                SELECT 1 FROM loads b WHERE b.restaurant_id = a.restaurant_id
                  AND b.since = (SELECT max(c.since) FROM loads c WHERE c.restaurant_id = a.restaurant_id AND c.since < a.since)
                  AND b.restaurant_name IS NOT DISTINCT FROM a.restaurant_name AND b.address IS NOT DISTINCT FROM a.address
                  AND b.cuisine_type IS NOT DISTINCT FROM a.cuisine_type AND b.is_active IS NOT DISTINCT FROM a.is_active)),
        ended AS (
            SELECT o.*, (SELECT min(n.since) FROM opened n WHERE n.restaurant_id = o.restaurant_id AND n.since > o.since) AS until,
                   restaurant_id || '|' || CAST(o.since AS DATE) AS name FROM opened o)
        SELECT {number('name')} AS restaurant_key, {LOADED_COLUMNS}, CAST(since AS DATE) AS record_start_date,
               coalesce(CAST(until AS DATE), {OPEN_END}) AS record_end_date, until IS NULL AS is_current,
               coalesce(until, since) AS updated_at
        FROM ended""", "silver_restaurants"),
    "dq_references": sql("""
        SELECT 'order_id has no rating' AS rule, count(*) AS total_rows,
               count(*) FILTER (WHERE order_id NOT IN (SELECT event_id FROM events)) AS invalid_rows
        FROM bronze_items""", "bronze_items"),
    "touched_days": sql(f"""
        SELECT DISTINCT CAST(least(o.order_time, {AS_OF}) AS DATE) AS day FROM bronze_orders o
        WHERE order_id IN (SELECT order_id FROM bronze_ratings WHERE rating_type = 'purchase')""",
        "bronze_orders", "bronze_ratings"),
    # content of layers
    "layer_fingerprints": sql(f"""
        SELECT CAST(order_time AS DATE) AS bucket, count(*) AS rows,
               CAST(sum(CAST('0x' || substr(md5(concat_ws('|', order_id, {CONTENT})), 1, 15) AS BIGINT)) AS VARCHAR)
                   AS fingerprint
        FROM silver_orders GROUP BY 1""", "silver_orders"),
    "content_differences": sql(f"""
        SELECT * FROM (
            SELECT order_id, CASE WHEN s.order_id IS NULL THEN 'left only' ELSE 'both' END AS side,
                   CASE WHEN s.order_id IS NOT NULL THEN concat_ws(',',
                     CASE WHEN b.status IS DISTINCT FROM s.status THEN 'status' END,
                     CASE WHEN {cents('b.total_amount')} IS DISTINCT FROM {cents('s.total_amount')} THEN 'total_cents' END,
                     CASE WHEN {cents('b.tip_amount')} IS DISTINCT FROM {cents('s.tip_amount')} THEN 'tip_cents' END,
                     CASE WHEN b.order_time IS DISTINCT FROM s.order_time THEN 'placed' END) END AS columns
            FROM bronze_orders b LEFT JOIN silver_orders s USING (order_id))
        WHERE side <> 'both' OR columns <> ''""", "bronze_orders", "silver_orders"),
    # facts
    "fact_orders": _whole("fact_orders"),
    "fact_orders_as_of": sql(f"""
        SELECT {key('o.order_id')} AS order_key, o.order_id, c.date_key, d.driver_key, r.restaurant_key, o.order_time,
               o.delivery_time, o.status, o.total_amount,
               {rounded('o.delivery_time_minutes', 1)} AS delivery_minutes,
               {rounded('o.prep_time_minutes', 1)} AS prep_time_minutes,
               coalesce(o.delivery_time_minutes > 45, false) AS sla_breached, o.cancelled, o.tip_amount,
               o.ingest_timestamp
        FROM silver_orders o
             LEFT JOIN ({_dated("driver_id", SCD2_DRIVERS)}) d ON o.driver_id = d.driver_id
               AND CAST(o.order_time AS DATE) >= d.since AND CAST(o.order_time AS DATE) < d.record_end_date
             LEFT JOIN ({_dated("restaurant_id", SCD2_RESTAURANTS)}) r ON o.restaurant_id = r.restaurant_id
               AND CAST(o.order_time AS DATE) >= r.since AND CAST(o.order_time AS DATE) < r.record_end_date
             LEFT JOIN calendar c ON CAST(o.order_time AS DATE) = c.full_date""",
        "silver_orders", "silver_drivers", "silver_restaurants", "calendar"),
    "fact_order_items": _whole("fact_items"),
    "fact_ratings": _whole("fact_ratings"),
    "fact_restaurant_daily": sql(f"""
        SELECT {key('p.restaurant_id', 'p.report_date')} AS restaurant_daily_key, d.restaurant_key, c.date_key, p.avg_prep_time, p.avg_rating, p.orders_count, p.cancel_rate,
               p.avg_tip, p.total_revenue, CAST(coalesce(s.n, 0) AS INTEGER) AS active_menu_items,
               p.ingest_timestamp
        FROM restaurant_performance p JOIN dim_restaurants d ON p.restaurant_id = d.restaurant_id
             JOIN calendar c ON p.report_date = c.full_date
             LEFT JOIN (SELECT CAST(o.order_time AS DATE) AS report_date, restaurant_id,
                               count(DISTINCT item_id) AS n
                        FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id GROUP BY 1, 2) s
               ON s.report_date = p.report_date AND s.restaurant_id = p.restaurant_id""",
        "restaurant_performance", "dim_restaurants", "calendar", "silver_items", "silver_orders"),
    "fact_driver_daily": sql(f"""
        SELECT {key('p.driver_id', 'p.report_date')} AS driver_daily_key, d.driver_key, c.date_key, p.avg_rating, p.orders_completed, p.avg_delivery_time, p.total_tips,
               p.total_tips * 1.2e0 AS total_earnings, p.orders_completed * 0.75e0 AS hours_worked,
               p.ingest_timestamp
        FROM driver_performance p JOIN dim_drivers d ON p.driver_id = d.driver_id
             JOIN calendar c ON p.report_date = c.full_date""",
        "driver_performance", "dim_drivers", "calendar"),
    "business_summary": sql(_business_summary("daily", "day"), "fact_orders", "fact_ratings",
                            "silver_drivers", "silver_restaurants"),
    "business_summary_hourly": sql(_business_summary("hourly", "hour"), "fact_orders", "fact_ratings",
                                   "silver_drivers", "silver_restaurants"),
    "recent_fact_orders": sql(f"""
        SELECT {key('order_id')} AS order_key, order_id, customer_id, coalesce(restaurant_key, -1) AS restaurant_key,
               coalesce(driver_key, -1) AS driver_key, CAST(order_time AS DATE) AS order_date, order_time,
               delivery_time, total_amount, tip_amount, delivery_time_minutes AS delivery_minutes,
               prep_time_minutes AS prep_minutes, cancelled, status, data_quality_score,
               {AS_OF} AS created_timestamp
        FROM scored LEFT JOIN dim_restaurants USING (restaurant_id) LEFT JOIN dim_drivers USING (driver_id)
        WHERE processing_timestamp >= {LOOKBACK}""", "scored", "dim_restaurants", "dim_drivers"),
    "customer_activity": sql(f"""
        SELECT customer_id, max(order_time) AS last_order_time, count(*) AS recent_order_count,
               {AS_OF} AS updated_timestamp
        FROM scored WHERE processing_timestamp >= {LOOKBACK} GROUP BY customer_id""", "scored"),
    # updates, late data
    "dedup_latest": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_status": sql("""
        SELECT coalesce(o.order_id, e.order_id) AS order_id, o.customer_id,
               CASE WHEN e.order_id IS NULL THEN o.status ELSE e.event_type END AS status,
               CASE WHEN e.order_id IS NULL THEN o.delivery_time ELSE e.ts END AS delivery_time
        FROM bronze_orders o
             FULL JOIN (SELECT event_id // 3 * 2 AS order_id, event_type, ts FROM events
                        QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY ts DESC, event_id DESC) = 1) e
               ON o.order_id = e.order_id""", "bronze_orders"),
    "merged_months": sql("""
        SELECT coalesce(o.order_id, e.order_id) AS order_id, o.customer_id,
               CASE WHEN e.order_id IS NULL THEN o.status ELSE e.event_type END AS status,
               CASE WHEN e.order_id IS NULL THEN o.delivery_time ELSE e.ts END AS delivery_time,
               CAST(date_trunc('month', CASE WHEN o.order_id IS NULL THEN e.ts ELSE o.order_time END) AS DATE) AS order_month
        FROM bronze_orders o
             FULL JOIN (SELECT event_id // 3 * 2 AS order_id, event_type, ts FROM events
                        QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY ts DESC, event_id DESC) = 1) e
               ON o.order_id = e.order_id""", "bronze_orders"),
    "lateness": f"SELECT * FROM {EVENTS_ARRIVED}",
    "lateness_summary": f"""
        SELECT lateness, count(*) AS records, max(lateness_minutes) AS max_lateness_minutes,
               {mean_minutes('lateness_minutes')} AS avg_lateness_minutes
        FROM {EVENTS_ARRIVED} GROUP BY lateness""",
    "recent_orders": sql(f"""
        SELECT order_id, order_time, status FROM bronze_orders WHERE order_time >= {LOOKBACK}""", "bronze_orders"),
    "late_confirmations": sql(f"""
        SELECT order_id, order_time, CASE status WHEN 'preparing' THEN 'delivered' ELSE status END AS status,
               CASE status WHEN 'preparing' THEN {AS_OF} ELSE delivery_time END AS delivery_time
        FROM bronze_orders""", "bronze_orders"),
    "late_impact": sql(f"""
        SELECT order_date, b_orders AS orders_before, a_orders AS orders_after,
               CAST(a_orders - coalesce(b_orders, 0) AS DOUBLE) AS orders_delta,
               b_cents / 1e2 AS revenue_before, a_cents / 1e2 AS revenue_after,
               (a_cents - coalesce(b_cents, 0)) / 1e2 AS revenue_delta
        FROM (SELECT CAST(order_time AS DATE) AS order_date, count(*) AS a_orders,
                     sum({cents('total_amount')}) AS a_cents,
                     nullif(count(*) FILTER (WHERE status <> 'preparing'), 0) AS b_orders,
                     sum({cents('total_amount')}) FILTER (WHERE status <> 'preparing') AS b_cents
              FROM bronze_orders GROUP BY 1)
        WHERE a_orders IS DISTINCT FROM b_orders OR a_cents IS DISTINCT FROM b_cents""", "bronze_orders"),
    "daily_windows": sql(f"""
        SELECT CAST(date_trunc('day', order_time) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('day', order_time) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
               count(*) AS total_orders, {money('total_amount')} AS total_revenue,
               count(*) FILTER (WHERE cancelled) AS cancelled_orders,
               {mean_minutes('delivery_time_minutes')} AS avg_delivery_time
        FROM silver_orders GROUP BY 1, 2""", "silver_orders"),
    # quality
    "dq_orders": sql(_quality("bronze_orders", *[
        (f"{c} is missing", f"{c} IS NULL") for c in ("order_id", "customer_id", "restaurant_id")]), "bronze_orders"),
    "dq_items": sql(_quality("bronze_items", ("quantity is not positive", "quantity <= 0"),
                             ("item_price is not positive", "item_price <= 0")), "bronze_items"),
    "dq_ratings": sql(_quality("bronze_ratings", *[_range_rule(c) for c in MARKS]), "bronze_ratings"),
    "rejected_ratings": sql("SELECT rating_id, concat_ws('; ', " + ", ".join(
        f"CASE WHEN {c} NOT BETWEEN 1 AND 5 THEN '{c} is out of range' END" for c in MARKS)
        + ") AS reasons FROM bronze_ratings WHERE "
        + " OR ".join(f"{c} NOT BETWEEN 1 AND 5" for c in MARKS), "bronze_ratings"),
    "rejected_orders": sql("""
        SELECT order_id, 'restaurant_id is missing' AS reasons FROM bronze_orders
        WHERE restaurant_id IS NULL""", "bronze_orders"),
    "orphan_lines": sql("""
        SELECT order_item_id, order_id, item_id FROM bronze_items
        WHERE order_id NOT IN (SELECT event_id FROM events)""", "bronze_items"),
    "orphan_ratings": """
        SELECT event_id AS rating_id, event_id AS order_id FROM events
        WHERE event_id NOT IN (SELECT o_orderkey FROM orders)""",
    "core_metrics_net": sql("""
        SELECT CAST(round(sum(CAST(net AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_revenue,
               """ + mean_money("net") + """ AS avg_order_value, count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT restaurant_id) AS active_restaurants
        FROM (SELECT order_id, customer_id, status FROM bronze_orders) JOIN (
              SELECT l_orderkey AS order_id, min(l_suppkey) AS restaurant_id, CAST(sum(CAST(
                         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))
                         * (1 + CAST(l_tax AS DECIMAL(3,2))) AS DECIMAL(20,6))) AS DOUBLE) AS net
              FROM lineitem GROUP BY l_orderkey) USING (order_id)
        WHERE """ + DELIVERED, "bronze_orders"),
    "layer_counts": sql(" UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {step}"
        for layer, name, step in [
            ("bronze", "bronze_orders", "bronze_orders"), ("bronze", "bronze_order_items", "bronze_items"),
            ("bronze", "bronze_ratings", "bronze_ratings"), ("silver", "silver_orders", "silver_orders"),
            ("gold", "fact_orders", "fact_orders"), ("gold", "fact_order_items", "fact_items"),
            ("gold", "fact_ratings", "fact_ratings")]),
        "bronze_orders", "bronze_items", "bronze_ratings", "silver_orders", "fact_orders", "fact_items",
        "fact_ratings"),
    # reports
    "order_detail": sql("""
        SELECT order_id, status, order_time, delivery_time, total_amount, tip_amount, restaurant_name,
               d.name AS driver_name, CAST(trunc(delivery_minutes) AS INTEGER) AS delivery_minutes, cancelled
        FROM fact_orders f LEFT JOIN dim_restaurants r ON f.restaurant_key = r.restaurant_key
             LEFT JOIN dim_drivers d ON f.driver_key = d.driver_key""",
        "fact_orders", "dim_restaurants", "dim_drivers"),
    "status_breakdown": sql(f"""
        SELECT status, count(*) AS order_count,
               {ratio('count(*) * 100', '(SELECT count(*) FROM silver_orders)', 1, 2)} AS percentage
        FROM silver_orders GROUP BY status""", "silver_orders"),
    "status_share": sql(f"""
        SELECT status, order_count, {ratio('order_count * 100', 'total', 1, 1)} AS percentage
        FROM (SELECT status, count(*) AS order_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total
              FROM bronze_orders GROUP BY status)""", "bronze_orders"),
    "orders_by_restaurant": sql("""
        SELECT restaurant_name, count(*) AS order_count
        FROM fact_orders JOIN dim_restaurants USING (restaurant_key) GROUP BY restaurant_name""",
        "fact_orders", "dim_restaurants"),
    "orders_by_date": sql("""
        SELECT CAST(order_time AS DATE) AS order_date, count(*) AS daily_orders
        FROM silver_orders GROUP BY 1""", "silver_orders"),
    "revenue_stats": sql(f"""
        SELECT {money('total_amount')} AS total_revenue, {mean_money('total_amount')} AS avg_order_value,
               min(total_amount) AS min_order, max(total_amount) AS max_order, {money('tip_amount')} AS total_tips,
               {mean_money('tip_amount')} AS avg_tip
        FROM silver_orders WHERE {DELIVERED}""", "silver_orders"),
    "revenue_summary": sql(f"""
        SELECT {money('total_amount')} AS total_revenue, {mean_money('total_amount')} AS avg_order_value,
               count(*) AS delivered_orders, {money('tip_amount')} AS total_tips
        FROM silver_orders WHERE {DELIVERED}""", "silver_orders"),
    "core_metrics": sql(f"""
        SELECT {money('total_amount')} AS total_revenue, {mean_money('total_amount')} AS avg_order_value,
               count(DISTINCT customer_id) AS unique_customers, count(DISTINCT restaurant_id) AS active_restaurants
        FROM bronze_orders WHERE {DELIVERED}""", "bronze_orders"),
    "customer_value": sql(f"""
        SELECT count(customer_id) AS total_customers, {ratio('sum(n)', 'count(n)', 1, 1)} AS avg_orders_per_customer,
               {ratio('sum(spent)', 'count(spent)', 10**6, 2)} AS avg_customer_value
        FROM (SELECT customer_id, count(*) AS n, {micros('total_amount')} AS spent
              FROM bronze_orders WHERE {DELIVERED} GROUP BY customer_id)""", "bronze_orders"),
    "peak_hours": sql("""
        SELECT CAST(hour(order_time) AS INTEGER) AS hour, count(*) AS order_count FROM bronze_orders GROUP BY 1""",
        "bronze_orders"),
    "delivery_stats": sql(f"""
        SELECT {ratio('sum(s)', 'count(s)', 60, 1)} AS avg_delivery_time,
               {ratio('count(*) FILTER (WHERE s <= 1800) * 100', 'count(*)', 1, 1)} AS on_time_percentage,
               count(DISTINCT driver_id) AS active_drivers
        FROM (SELECT driver_id, date_diff('second', order_time, delivery_time) AS s FROM bronze_orders
              WHERE {DELIVERED} AND delivery_time IS NOT NULL)""", "bronze_orders"),
    "cuisine_performance": sql(f"""
        SELECT n_name AS cuisine_type, CAST(sum(n) AS BIGINT) AS total_orders,
               CAST(round(sum(revenue), 2) AS DOUBLE) AS total_revenue,
               {ratio('sum(marks)', 'sum(rated)', 10, 2)} AS avg_rating
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
             JOIN (SELECT restaurant_id, count(*) AS n, sum(CAST(total_amount AS DECIMAL(28,6))) AS revenue FROM bronze_orders
                   WHERE {DELIVERED} GROUP BY restaurant_id) o ON s_suppkey = o.restaurant_id
             LEFT JOIN (SELECT restaurant_id, sum({tenths('food_rating')}) AS marks, count(*) AS rated
                        FROM silver_ratings GROUP BY restaurant_id) r ON s_suppkey = r.restaurant_id
        GROUP BY n_name""", "bronze_orders", "silver_ratings"),
    "metric_rows": sql(f"""
        SELECT 'Orders' AS metric, CAST(count(*) AS DOUBLE) AS value FROM silver_orders
        UNION ALL SELECT 'Revenue', {money('total_amount')} FROM silver_orders""", "silver_orders"),
    "order_totals": sql(f"""
        SELECT level, status, order_date, metric, value FROM (
            SELECT CASE WHEN GROUPING(status) = 0 AND GROUPING(order_date) = 0 THEN 'status and day'
                        WHEN GROUPING(status) = 0 THEN 'status' WHEN GROUPING(order_date) = 0 THEN 'day' ELSE 'all' END AS level,
                   status, order_date, CAST(count(*) AS DOUBLE) AS orders, {money('total_amount')} AS revenue,
                   {money('tip_amount')} AS tips, CAST(count(*) FILTER (WHERE cancelled) AS DOUBLE) AS cancelled
            FROM (SELECT *, CAST(order_time AS DATE) AS order_date FROM fact_orders)
            GROUP BY GROUPING SETS ((status, order_date), (status), (order_date), ()))
        UNPIVOT INCLUDE NULLS (value FOR metric IN (orders, revenue, tips, cancelled))""", "fact_orders"),
    "top_restaurants": sql(f"""
        SELECT restaurant_name, cuisine_type, count(order_id) AS total_orders,
               {money('total_amount')} AS total_revenue, {mean_money('total_amount')} AS avg_order_value
        FROM fact_orders JOIN dim_restaurants USING (restaurant_key) WHERE {DELIVERED}
        GROUP BY restaurant_name, cuisine_type ORDER BY total_revenue DESC, restaurant_name LIMIT 10""",
        "fact_orders", "dim_restaurants"),
    "top_restaurants_rated": sql(f"""
        SELECT restaurant_name, count(*) AS order_count, {money('total_amount')} AS revenue,
               {ratio('sum(marks)', 'sum(rated)', 10, 2)} AS avg_rating
        FROM fact_orders JOIN dim_restaurants USING (restaurant_key)
             LEFT JOIN {RATED_ORDERS.format(m=tenths('food_rating'))} USING (order_id)
        WHERE {DELIVERED} GROUP BY restaurant_name ORDER BY revenue DESC, restaurant_name LIMIT 5""",
        "fact_orders", "dim_restaurants", "silver_ratings"),
    "top_drivers": sql(f"""
        SELECT name AS driver_name, count(*) AS deliveries, {mean_mark('delivery_minutes')} AS avg_delivery_time,
               {ratio('sum(marks)', 'sum(rated)', 10, 2)} AS avg_rating
        FROM fact_orders JOIN dim_drivers USING (driver_key)
             LEFT JOIN {RATED_ORDERS.format(m=tenths('driver_rating'))} USING (order_id)
        WHERE {DELIVERED} GROUP BY name ORDER BY deliveries DESC, driver_name LIMIT 5""",
        "fact_orders", "dim_drivers", "silver_ratings"),
    "daily_trends": sql(f"""
        SELECT full_date AS order_date, count(*) AS daily_orders, {money('total_amount')} AS daily_revenue
        FROM fact_orders JOIN calendar USING (date_key) GROUP BY 1 ORDER BY 1 DESC LIMIT 7""",
        "fact_orders", "calendar"),
    "rating_summary": sql(f"""
        SELECT 'overall' AS rating_type, {mean_mark('driver_rating', 2)} AS avg_driver_rating,
               {mean_mark('food_rating', 2)} AS avg_food_rating,
               {mean_mark('delivery_rating', 2)} AS avg_delivery_rating, count(*) AS total_ratings
        FROM silver_ratings""", "silver_ratings"),
    "top_rated": sql(f"""
        SELECT restaurant_name, sum({tenths('food_rating')}) / (10e0 * count(food_rating)) AS avg_rating,
               count(*) AS rating_count
        FROM fact_ratings JOIN dim_restaurants USING (restaurant_key) GROUP BY restaurant_name""",
        "fact_ratings", "dim_restaurants"),
    "latest_summary": sql(_business_summary("daily", "day") + " ORDER BY date_key DESC LIMIT 5",
                          "fact_orders", "fact_ratings", "silver_drivers", "silver_restaurants"),
    "synth_stats": sql(f"""
        SELECT 'orders by status' AS statistic, status AS item, CAST(count(*) AS DOUBLE) AS value
        FROM bronze_orders GROUP BY status
        UNION ALL
        SELECT 'busiest restaurants', CAST(restaurant_id AS VARCHAR), n FROM (
            SELECT restaurant_id, count(*) AS n FROM bronze_orders WHERE restaurant_id IS NOT NULL
            GROUP BY restaurant_id ORDER BY n DESC, restaurant_id LIMIT 5)
        UNION ALL """ + " UNION ALL ".join(
            f"SELECT 'mean rating', '{c}', {mean_mark(c, 2)} FROM silver_ratings" for c in MARKS),
        "bronze_orders", "silver_ratings"),
}
