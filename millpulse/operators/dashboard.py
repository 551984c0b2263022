"""Live view: latest reading per machine, recent messages and counters, over landed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions.coercion import two_decimals
from millpulse.functions.rules import MART_ANOMALY_TEMPERATURE

PAYLOAD = ("timestamp", "machine_id", "temperature", "vibration")


def latest_per_machine(messages: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The message that arrived last for each machine, whatever its own timestamp says; ties go to the smaller content."""
    last = Window.partitionBy("machine_id").orderBy(F.col(arrival).desc(), *_by_content("machine_id"))
    return (
        messages.select(*PAYLOAD, arrival).withColumn("_rank", F.row_number().over(last))
        .filter("_rank = 1").drop("_rank")
    )


def recent_messages(messages: DataFrame, n: int = 100, arrival: str = "arrival") -> DataFrame:
    """The n messages that arrived last, newest first; of messages that arrived together the smaller content comes first."""
    return messages.select(*PAYLOAD, arrival).orderBy(F.col(arrival).desc(), *_by_content()).limit(n)


def _by_content(*but: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in PAYLOAD if name not in but]


def dashboard_rows(latest: DataFrame) -> DataFrame:
    """Display rows in language order of the machine: fixed two decimals and a class for hot machines."""
    return latest.select(
        "machine_id",
        F.when(F.col("temperature") >= MART_ANOMALY_TEMPERATURE, "hot").otherwise("ok").alias("temperature_class"),
        two_decimals(F.col("temperature")).alias("temperature_text"),
        two_decimals(F.col("vibration")).alias("vibration_text"),
        "timestamp",
    ).orderBy(F.collate("machine_id", "UNICODE"), "machine_id")


def message_counters(per_machine: DataFrame, published: DataFrame) -> DataFrame:
    """Totals over (machine_id, received, rejected) counts, and the rows of `published`.

    A message is received once it is accepted, and published once the sink has committed it; between the two, or when
    the sink fails, the totals differ. Machines with accepted messages are counted.
    """
    totals = per_machine.agg(
        F.coalesce(F.sum("received"), F.lit(0)).alias("total_received"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("total_rejected"),
        F.count_if(F.col("received") > 0).alias("machine_count"),
    )
    # Two one-row aggregates, folded into one row.
    both = totals.unionByName(published.agg(F.count(F.lit(1)).alias("total_published")), allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in ("total_received", "total_rejected", "total_published", "machine_count")])
