"""Schemas of the layers: what each source must deliver and what each table holds."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(),
}


def _schema(spec: str) -> T.StructType:
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# Messages carry every value as a string; nullability is checked after parsing.
WIRE_ORDERS = _schema(
    "order_id string, customer_id string, restaurant_id string, driver_id string, "
    "order_timestamp string, order_status string, delivery_timestamp string, total_amount string, "
    "prep_start_timestamp string, prep_end_timestamp string, tip_amount string")
WIRE_ORDER_ITEMS = _schema(
    "order_item_id string, order_id string, item_id string, quantity string, "
    "item_price string, order_time string")

BRONZE = {
    "orders": _schema(
        "order_id string, customer_id string, restaurant_id string, driver_id string, "
        "order_time timestamp, status string, delivery_time timestamp, total_amount double, "
        "prep_start_time timestamp, prep_end_time timestamp, tip_amount double"),
    "order_items": _schema(
        "order_item_id string, order_id string, item_id string, quantity int, "
        "item_price double, order_time timestamp"),
    "ratings": _schema(
        "rating_id string, order_id string, driver_id string, restaurant_id string, "
        "driver_rating double, food_rating double, delivery_rating double, "
        "rating_time timestamp, rating_type string"),
    "restaurants": _schema(
        "restaurant_id string, name string, cuisine_type string, address string, "
        "phone string, rating double, is_active boolean"),
    "drivers": _schema(
        "driver_id string, name string, phone string, vehicle_type string, "
        "rating double, is_active boolean"),
    "menu_items": _schema(
        "item_id string, restaurant_id string, name string, description string, "
        "price double, is_available boolean, category string"),
    "weather": _schema(
        "date string, temperature_celsius double, humidity_percent int, "
        "conditions string, wind_speed_kmh double"),
}

SILVER_COLUMNS = {
    "orders": ["order_id", "customer_id", "restaurant_id", "driver_id", "status", "order_time",
               "delivery_time", "total_amount", "prep_time_minutes", "delivery_time_minutes",
               "tip_amount", "cancelled", "ingest_timestamp"],
    "order_items": ["order_item_id", "order_id", "item_id", "quantity", "item_price",
                    "extended_price", "order_time", "ingest_timestamp"],
    "menu_items": ["item_id", "restaurant_id", "item_name", "category", "base_price", "ingest_timestamp"],
    "drivers": ["driver_id", "name", "phone", "vehicle_type", "rating", "is_active", "ingest_timestamp"],
    "restaurants": ["restaurant_id", "restaurant_name", "cuisine_type", "address", "phone", "rating",
                    "is_active", "ingest_timestamp"],
    "ratings": ["rating_id", "order_id", "driver_id", "restaurant_id", "driver_rating", "food_rating",
                "delivery_rating", "rating_time", "rating_type", "ingest_timestamp"],
    "restaurant_performance": ["report_date", "restaurant_id", "avg_prep_time", "avg_rating",
                               "orders_count", "cancel_rate", "avg_tip", "total_revenue",
                               "ingest_timestamp"],
    "driver_performance": ["report_date", "driver_id", "avg_rating", "orders_completed",
                           "avg_delivery_time", "total_tips", "ingest_timestamp"],
    "weather": ["date", "temperature_celsius", "humidity_percent", "conditions", "wind_speed_kmh",
                "ingest_timestamp"],
    "daily_performance": ["performance_date", "restaurant_id", "driver_id", "total_orders",
                          "unique_customers", "total_revenue", "avg_delivery_time", "avg_prep_time",
                          "cancelled_orders", "avg_quality_score", "processing_timestamp"],
}

GOLD_COLUMNS = {
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "week", "day_of_week",
                 "month_name", "day_name", "is_weekend", "is_holiday"],
    "dim_drivers": ["driver_key", "driver_id", "name", "phone", "vehicle_type", "rating", "is_active",
                    "record_start_date", "record_end_date", "is_current", "ingest_timestamp",
                    "updated_at"],
    "dim_restaurants": ["restaurant_key", "restaurant_id", "restaurant_name", "cuisine_type", "address",
                        "phone", "rating", "is_active", "record_start_date", "record_end_date",
                        "is_current", "ingest_timestamp", "updated_at"],
    "dim_menu_items": ["menu_item_key", "item_id", "item_name", "category", "base_price", "active_flag",
                       "ingest_timestamp"],
    "fact_orders": ["order_key", "order_id", "date_key", "driver_key", "restaurant_key", "order_time",
                    "delivery_time", "status", "total_amount", "delivery_minutes", "prep_time_minutes",
                    "sla_breached", "cancelled", "tip_amount", "ingest_timestamp"],
    # order_id follows the model's columns in both child facts: reports join on it
    "fact_order_items": ["order_item_key", "order_key", "menu_item_key", "quantity", "item_price",
                         "extended_price", "date_key", "order_time", "order_id"],
    "fact_ratings": ["rating_key", "order_key", "driver_key", "restaurant_key", "driver_rating",
                     "food_rating", "delivery_rating", "rating_time", "rating_type", "date_key",
                     "order_id"],
    "fact_restaurant_daily": ["restaurant_daily_key", "restaurant_key", "date_key", "avg_prep_time",
                              "avg_rating", "orders_count", "cancel_rate", "avg_tip", "total_revenue",
                              "active_menu_items", "ingest_timestamp"],
    "fact_driver_daily": ["driver_daily_key", "driver_key", "date_key", "avg_rating",
                          "orders_completed", "avg_delivery_time", "total_tips", "total_earnings",
                          "hours_worked", "ingest_timestamp"],
    "fact_business_summary": ["summary_key", "date_key", "time_period", "total_orders", "total_revenue",
                              "avg_order_value", "active_drivers", "active_restaurants",
                              "overall_satisfaction", "avg_delivery_time", "total_tips",
                              "sla_breach_rate", "period_start", "ingest_timestamp"],
    "customer_activity": ["customer_id", "last_order_time", "recent_order_count", "updated_timestamp"],
}

# Tables split by day: partition column and the column its day is taken from.
# Late rows then cost the days they fall on, not the table.
PARTITIONED = {
    "bronze_orders": ("order_date", "order_time"),
    "bronze_order_items": ("order_date", "order_time"),
    "bronze_ratings": ("rating_date", "rating_time"),
    "silver_orders": ("order_date", "order_time"),
    "silver_order_items": ("order_date", "order_time"),
    "silver_ratings": ("rating_date", "rating_time"),
    "fact_orders": ("order_date", "order_time"),
    "fact_order_items": ("order_date", "order_time"),
    "fact_ratings": ("rating_date", "rating_time"),
    "silver_restaurant_performance": ("performance_day", "report_date"),
    "silver_driver_performance": ("performance_day", "report_date"),
    "silver_daily_performance": ("performance_day", "performance_date"),
    "silver_scored_orders": ("order_date", "order_time"),
    "fact_orders_stream": ("order_day", "order_time"),
    "fact_order_items_stream": ("order_day", "order_time"),
    "orphan_order_items_stream": ("order_day", "order_time"),
    "fact_restaurant_daily": ("performance_day", "date_key"),
    "fact_driver_daily": ("performance_day", "date_key"),
    "fact_business_summary": ("summary_day", "period_start"),
}

LAYERS = {
    "bronze": [f"bronze_{t}" for t in BRONZE] + ["quarantine_orders", "quarantine_order_items"],
    "silver": [f"silver_{t}" for t in SILVER_COLUMNS] + ["silver_scored_orders", "orphan_order_items_stream"],
    "gold": [*GOLD_COLUMNS, "fact_orders_stream", "fact_order_items_stream"],
}
