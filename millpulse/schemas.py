"""Declared schemas for the raw, source and landed tables."""

from pyspark.sql import types as T

SENSOR_RAW = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
])

MACHINE_STATUS_RAW = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_updated", T.TimestampNTZType()),
])

WORK_ORDERS_RAW = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("target_quantity", T.DecimalType(38, 0)),
    T.StructField("order_status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# The plant database that the status and order extracts read from.
MACHINE_STATUS_SOURCE = T.StructType([
    T.StructField("machine_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("last_updated", T.TimestampType(), False),
])

WORK_ORDERS_SOURCE = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("machine_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("target_quantity", T.IntegerType(), False),
    T.StructField("order_status", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

RAW_TABLES = {
    "sensor_data_raw": SENSOR_RAW,
    "machine_status_raw": MACHINE_STATUS_RAW,
    "work_orders_raw": WORK_ORDERS_RAW,
}

SOURCE_TABLES = {
    "machine_status": MACHINE_STATUS_SOURCE,
    "work_orders": WORK_ORDERS_SOURCE,
}

PRIMARY_KEYS = {"machine_status": ["machine_id"], "work_orders": ["order_id"]}

# Columns whose missing value means "now" in the plant database.
DEFAULT_NOW = {"machine_status": ["last_updated"], "work_orders": ["created_at"]}


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns read as strings, ready for tolerant casts."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
