"""Cleaned views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions.ids import blank_to_null, clean_machine_id, clean_status


def stg_sensor_data(raw: DataFrame) -> DataFrame:
    """Readings with a time and a usable machine id."""
    return raw.select(
        F.col("timestamp").alias("event_ts"),
        clean_machine_id(F.col("machine_id")).alias("machine_id"),
        "temperature",
        "vibration",
    ).filter(F.col("event_ts").isNotNull() & F.col("machine_id").isNotNull())


def stg_machine_status(raw: DataFrame) -> DataFrame:
    """Status history with a usable machine id and status."""
    return raw.select(
        clean_machine_id(F.col("machine_id")).alias("machine_id"),
        clean_status(F.col("status")).alias("status"),
        F.col("last_updated").alias("status_ts"),
    ).filter(F.col("machine_id").isNotNull() & F.col("status").isNotNull())


def stg_work_orders(raw: DataFrame) -> DataFrame:
    """The newest row per order; an order that never got a time is kept.

    Rows of one order with the same time are told apart by their remaining columns, so the choice
    does not depend on how the input is split. Each task keeps one row per order before the shuffle.
    """
    rows = raw.select(
        blank_to_null(F.col("order_id")).alias("order_id"),
        blank_to_null(F.col("machine_id")).alias("machine_id"),
        "product_name",
        "target_quantity",
        "order_status",
        "created_at",
    ).filter(F.col("order_id").isNotNull() & F.col("machine_id").isNotNull())
    newest = Window.partitionBy("order_id").orderBy(
        F.col("created_at").desc_nulls_last(),
        F.col("machine_id").asc(),
        F.col("product_name").asc_nulls_last(),
        F.col("target_quantity").asc_nulls_last(),
        F.col("order_status").asc_nulls_last(),
    )
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
