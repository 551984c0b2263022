"""Current machine status and its match to sensor machines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions.ids import machine_key, machine_num
from millpulse.operators.joins import salted_join


def latest_status(status: DataFrame) -> DataFrame:
    """The newest status per machine key. A row without a time counts as the newest."""
    newest = Window.partitionBy("machine_key").orderBy(
        F.col("status_ts").desc_nulls_first(), F.col("status").asc(), F.col("machine_id").asc()
    )
    return (
        status.withColumn("machine_key", machine_key(F.col("machine_id")))
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .select("machine_key", machine_num(F.col("machine_id")).alias("machine_num"), "status")
    )


def status_matches(machines: DataFrame, latest: DataFrame) -> DataFrame:
    """(machine_id, status, copies): every status that a sensor machine matches, and how often.

    Two machines match when both have a number and the numbers agree, or when at least one has no
    number and the keys agree. That "or" is expressed as one equality over text tokens:

    * ``num:<n>``   number against number,
    * ``any:<key>`` a sensor machine without a number against every status key,
    * ``non:<key>`` a numbered sensor machine against status keys without a number.

    Statuses are counted per token before the join, so machines that share a number do not form
    pairs with all status rows of that number.
    """
    key, num = F.col("machine_key"), F.col("machine_num")
    status_tokens = (
        latest.select(
            "status",
            F.explode(
                F.when(num.isNotNull(), F.array(F.concat(F.lit("num:"), num.cast("string")), F.concat(F.lit("any:"), key)))
                .otherwise(F.array(F.concat(F.lit("any:"), key), F.concat(F.lit("non:"), key)))
            ).alias("token"),
        )
        .groupBy("token", "status")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    machine_tokens = (
        machines.select("machine_id")
        .distinct()
        .select("machine_id", machine_key(F.col("machine_id")).alias("machine_key"), machine_num(F.col("machine_id")).alias("machine_num"))
        .select(
            "machine_id",
            F.explode(
                F.when(num.isNotNull(), F.array(F.concat(F.lit("num:"), num.cast("string")), F.concat(F.lit("non:"), key)))
                .otherwise(F.array(F.concat(F.lit("any:"), key)))
            ).alias("token"),
        )
    )
    return salted_join(machine_tokens, status_tokens, "token", ["machine_id"], how="inner").select(
        "machine_id", "status", "copies"
    )


COPIES_PER_STEP = 1_000


def with_status_weight(hourly: DataFrame, latest: DataFrame) -> DataFrame:
    """Add `current_status` ('UNKNOWN' without a match) and `copies`, how many status rows stand behind it."""
    return hourly.join(status_matches(hourly, latest), "machine_id", "left").select(
        *hourly.columns,
        F.coalesce("status", F.lit("UNKNOWN")).alias("current_status"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def expand_copies(weighted: DataFrame) -> DataFrame:
    """One row per copy. Steps and copies within a step are exploded one after the other, so no array grows with the count."""
    last = F.col("copies") - 1
    steps = weighted.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_PER_STEP))))
    in_step = F.least(F.lit(COPIES_PER_STEP), F.col("copies") - F.col("_step") * COPIES_PER_STEP)
    return steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_step))).drop("copies", "_step", "_copy")


def attach_current_status(hourly: DataFrame, latest: DataFrame) -> DataFrame:
    """Add `current_status`, one output row per matching status row, 'UNKNOWN' without a match."""
    return expand_copies(with_status_weight(hourly, latest))


def unmatched_machines(sensor: DataFrame, status: DataFrame) -> DataFrame:
    """Sensor machines that match no status row."""
    machines = sensor.select("machine_id").distinct()
    return machines.join(status_matches(machines, latest_status(status)), "machine_id", "left_anti")


def key_coverage(sensor: DataFrame, status: DataFrame) -> DataFrame:
    """How many sensor machines have a status."""
    machines = sensor.select("machine_id").distinct()
    matched = (
        status_matches(machines, latest_status(status))
        .select("machine_id").distinct().withColumn("matched", F.lit(True))
    )
    return machines.join(matched, "machine_id", "left").agg(
        F.count(F.lit(1)).alias("sensor_keys"),
        F.count("matched").alias("matched_keys"),
        F.count_if(F.col("matched").isNull()).alias("unmatched_keys"),
    )


def backfill_status(sensor: DataFrame, status: DataFrame, default_status: str, status_ts: datetime) -> DataFrame:
    """The status history plus one default row for each sensor machine without any."""
    added = unmatched_machines(sensor, status).select(
        "machine_id",
        F.lit(default_status).alias("status"),
        F.lit(status_ts).cast("timestamp_ntz").alias("status_ts"),
    )
    return status.select("machine_id", "status", "status_ts").unionByName(added)
