"""JSON messages to bronze rows. Works the same on a batch frame and on a stream.

A message that does not parse, or lacks a value its table cannot do without, is
not lost: it stays in the output with `decoded = false` and its raw text, for
`quarantined` to pick out.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake.schemas import BRONZE, WIRE_ORDER_ITEMS, WIRE_ORDERS

# Message field names that differ from the column they fill.
RENAMED = {
    "order_timestamp": "order_time",
    "order_status": "status",
    "delivery_timestamp": "delivery_time",
    "prep_start_timestamp": "prep_start_time",
    "prep_end_timestamp": "prep_end_time",
}


def _decode(messages: DataFrame, wire: T.StructType, table: T.StructType, key: str) -> DataFrame:
    """`messages` has a `value` (string or binary) and may have an `arrival_time`."""
    field_of = {RENAMED.get(f.name, f.name): F.col(f"m_{f.name}") for f in wire.fields}
    text = F.col("value").cast("string")
    carried = ["arrival_time"] if "arrival_time" in messages.columns else []
    # the generator keeps the optimizer from parsing the text once per field
    parsed = (messages.select(*carried, text.alias("raw"), F.inline(F.array(F.from_json(text, wire))))
              .withColumnsRenamed({f.name: f"m_{f.name}" for f in wire.fields}))
    # try_cast gives null for text a type cannot hold, where cast would end the query
    typed = {f.name: field_of[f.name].try_cast(f.dataType) for f in table.fields}
    unreadable = F.lit(False)
    for name, value in typed.items():
        unreadable = unreadable | (field_of[name].isNotNull() & value.isNull())
    return parsed.select(
        *[value.alias(name) for name, value in typed.items()], *carried, "raw",
        (typed[key].isNotNull() & ~unreadable).alias("decoded"))


def decode_orders(messages: DataFrame) -> DataFrame:
    return _decode(messages, WIRE_ORDERS, BRONZE["orders"], "order_id")


def decode_order_items(messages: DataFrame) -> DataFrame:
    return _decode(messages, WIRE_ORDER_ITEMS, BRONZE["order_items"], "order_item_id")


DECODERS = {"orders": decode_orders, "order_items": decode_order_items}


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.filter("decoded").drop("raw", "decoded")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col("decoded")).select(
        "raw", *[c for c in ("arrival_time",) if c in decoded.columns])


def encode(rows: DataFrame, wire: T.StructType) -> DataFrame:
    """Rows as messages, every value a string: what a producer would send."""
    column_of = {f.name: RENAMED.get(f.name, f.name) for f in wire.fields}

    def text(name: str) -> Column:
        return F.col(column_of[name]).cast("string").alias(name)

    return rows.select(F.to_json(F.struct(*[text(f.name) for f in wire.fields])).alias("value"))
