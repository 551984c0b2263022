"""Daily work-order counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.functions.rules import day_of

EPOCH = "1970-01-01 00:00:00"


def work_orders_status(orders: DataFrame) -> DataFrame:
    """Orders and target quantity per day, machine and status; undated orders fall on the epoch."""
    created = F.coalesce("created_at", F.lit(EPOCH).cast("timestamp_ntz"))
    return (
        orders.filter(F.col("machine_id").isNotNull())
        .groupBy(
            day_of(created).alias("order_day"),
            "machine_id",
            F.coalesce("order_status", F.lit("UNKNOWN")).alias("order_status"),
        )
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(F.coalesce(F.col("target_quantity").cast("long"), F.lit(0))).alias("target_quantity_sum"),
        )
    )
