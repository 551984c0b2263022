"""Continuously updated tables: latest reading and counts per machine, hourly health."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millpulse.functions import rules
from millpulse.streaming import state


def write_version(path: str, key: str = "machine_id", every: int = state.SNAPSHOT_EVERY) -> Callable[[DataFrame, int], None]:
    """Store each batch in its own folder, and the newest rows per key in a snapshot now and then."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state.store_batch(batch, path, batch_id)
        state.fold(batch.sparkSession, path, batch_id, lambda rows: _newest_rows(rows, key), every)

    return write


def _newest_rows(rows: DataFrame, key: str) -> DataFrame:
    newest = Window.partitionBy(key).orderBy(F.col("batch_id").desc())
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def start_versions(rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """Run a keyed aggregation in update mode: every batch stores the keys it changed."""
    writer = rows.writeStream.outputMode("update").foreachBatch(write_version(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def read_versions(spark: SparkSession, path: str, key: str = "machine_id", every: int = state.SNAPSHOT_EVERY) -> DataFrame:
    """The newest stored row per key."""
    return _newest_rows(state.read_state(spark, path, state.latest_batch(spark, path), every), key).drop("batch_id")


def stream_latest(payloads: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Latest payload per machine by arrival."""
    payload = F.struct("timestamp", "temperature", "vibration", arrival)
    return payloads.groupBy("machine_id").agg(F.max_by(payload, F.col(arrival)).alias("last")).select("machine_id", "last.*")


def stream_counts(validated: DataFrame) -> DataFrame:
    """Received (accepted) and rejected messages per machine id; rejected ones may have none."""
    return validated.groupBy("machine_id").agg(
        F.count_if("is_valid").alias("received"), F.count_if(~F.col("is_valid")).alias("rejected")
    )


def stream_health_hourly(readings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Hourly readings as a stream; an hour is emitted once the watermark has passed it."""
    timed = readings.withColumn("event_time", F.col("event_ts").cast("timestamp")).withWatermark("event_time", delay)
    return timed.groupBy(F.window("event_time", "1 hour").alias("hour"), "machine_id").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.avg("vibration").alias("avg_vibration"),
        F.sum(rules.anomaly_expr(F.col("temperature"), F.col("vibration"))).alias("anomaly_events"),
        F.count(F.lit(1)).alias("total_events"),
    ).select(
        F.col("hour.start").cast("timestamp_ntz").alias("hour_ts"),
        "machine_id", "avg_temperature", "avg_vibration", "anomaly_events", "total_events",
    )
