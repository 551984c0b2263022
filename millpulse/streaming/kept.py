"""Live tables that a stream keeps below a folder: recent messages, latest per machine with expiry, hours with their late rows.

Each is a batch function for `foreachBatch` and a reader. A batch may be repeated; readers see whole batches only.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.operators.dashboard import recent_messages
from millpulse.streaming.buckets import BUCKETS, MERGE_EVERY, BucketStore, Kept
from millpulse.streaming.risk import SUMS, hourly_partials

Batch = Callable[[DataFrame, int], None]
_PAYLOAD = "timestamp string, machine_id string, temperature double, vibration double"


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


# ---- recent messages --------------------------------------------------------------------------

def _recent_table(n: int, arrival: str) -> dict[str, Kept]:
    return {"recent": Kept(f"{_PAYLOAD}, {arrival} long", "machine_id", lambda rows: recent_messages(rows, n, arrival))}


def recent_keeper(path: str, n: int = 100, arrival: str = "arrival") -> Batch:
    """Keep the n newest messages. Each task cuts its rows to n before they meet those kept before."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        store = BucketStore(batch.sparkSession, path, _recent_table(n, arrival), 1, 1, batch_id)
        before = store.read("recent")
        newest = recent_messages(before.unionByName(batch.select(before.columns)), n, arrival)
        store.put("recent", newest, [0], replace=True)
        store.commit()

    return keep


def read_recent(spark: SparkSession, path: str, n: int = 100, arrival: str = "arrival") -> DataFrame:
    """The messages of `recent_messages` over all batches, newest first."""
    return BucketStore(spark, path, _recent_table(n, arrival)).read("recent")


# ---- latest message per machine ---------------------------------------------------------------

def _last_arrived(rows: DataFrame, arrival: str) -> DataFrame:
    """One row per machine, the last by arrival; of rows that arrived together the one with the smaller content."""
    last = Window.partitionBy("machine_id").orderBy(
        F.col(arrival).desc(), *[F.col(c).asc_nulls_last() for c in ("timestamp", "temperature", "vibration")], F.col("seen_at").desc()
    )
    return rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def _latest_table(arrival: str, since: datetime | None = None) -> dict[str, Kept]:
    def merge(rows: DataFrame) -> DataFrame:
        left = _last_arrived(rows, arrival)
        return left if since is None else left.where(F.col("seen_at") >= F.lit(since).cast("timestamp_ntz"))

    return {"latest": Kept(f"{_PAYLOAD}, {arrival} long, seen_at timestamp_ntz", "machine_id", merge)}


def latest_keeper(
    path: str, seen_at: Column, silent_after: timedelta, arrival: str = "arrival", buckets: int = BUCKETS, every: int = MERGE_EVERY
) -> Batch:
    """Keep the last message per machine until the machine has been silent for `silent_after`.

    `seen_at` is the time of receipt; the newest of all messages so far is the clock. So the rows depend on the messages
    only, not on how they were cut into batches. A batch opens the buckets of its own machines; those of expired
    machines are removed when their bucket is merged, and are not read before.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = BucketStore(spark, path, _latest_table(arrival), buckets, every, batch_id)
        rows = batch.select(*[c.split()[0] for c in _PAYLOAD.split(", ")], arrival, seen_at.cast("timestamp_ntz").alias("seen_at"))
        last = _last_arrived(rows, arrival).persist()
        try:
            times = [t for t in (_time(store.facts.get("newest")), rows.agg(F.max("seen_at")).first()[0]) if t]
            newest = max(times, default=None)
            if newest:
                store.tables = _latest_table(arrival, newest - silent_after)
            store.put("latest", last, store.touched(last, "machine_id"))
            store.commit(newest=newest.isoformat() if newest else None, silent_seconds=silent_after.total_seconds())
        finally:
            last.unpersist()

    return keep


def read_latest(spark: SparkSession, path: str, arrival: str = "arrival") -> DataFrame:
    """The last message of each machine that has not expired."""
    store = BucketStore(spark, path, _latest_table(arrival))
    newest = _time(store.facts.get("newest"))
    if newest:
        store.tables = _latest_table(arrival, newest - timedelta(seconds=store.facts["silent_seconds"]))
    return store.read("latest")


# ---- hours and what came too late for them ----------------------------------------------------

_HOURS = (
    "hour_ts timestamp_ntz, machine_id string, temperature_sum double, temperature_n long, vibration_sum double, vibration_n long, "
    "anomaly_events long, total_events long"
)
LATE = "event_ts timestamp_ntz, machine_id string, temperature double, vibration double"


def _add_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hour_ts", "machine_id").agg(*[F.sum(c).alias(c) for c in SUMS])


_OPEN = {"open": Kept(_HOURS, "machine_id", _add_up)}


def hours_keeper(path: str, delay: timedelta, buckets: int = 1) -> Batch:
    """Hourly readings that close once the newest reading is `delay` past them, and the readings that came too late for that.

    The rule is that of a watermark: it stands `delay` before the newest reading of all earlier batches, a reading is late
    when its hour ended before it, and a batch closes the hours that end before where it moves. Late readings are stored, not
    dropped, so closed, open and late readings are all readings. Only open hours are kept and read again.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        store = BucketStore(batch.sparkSession, path, _OPEN, buckets, 1, batch_id)
        watermark = _time(store.facts.get("watermark"))
        readings = batch.select(*[c.split()[0] for c in LATE.split(", ")]).persist()
        try:
            newest = readings.agg(F.max("event_ts")).first()[0]
            moved = max([t for t in (watermark, newest - delay if newest else None) if t], default=None)
            is_late = _ended(F.date_trunc("hour", "event_ts"), watermark)
            store.append("late", readings.where(is_late))
            hours = _add_up(store.read("open").unionByName(hourly_partials(readings.where(~is_late)).select(*_columns(_HOURS)))).persist()
            closes = _ended(F.col("hour_ts"), moved)
            store.append("closed", hours.where(closes))
            store.put("open", hours.where(~closes), range(store.buckets), replace=True)
            store.commit(watermark=moved.isoformat() if moved else None)
            hours.unpersist()
        finally:
            readings.unpersist()

    return keep


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _ended(hour: Column, watermark: datetime | None) -> Column:
    """Whether an hour lies wholly before the watermark."""
    if watermark is None:
        return F.lit(False)
    return hour.cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") <= F.lit(watermark).cast("timestamp_ntz")


def _averaged(hours: DataFrame) -> DataFrame:
    return hours.select(
        "hour_ts", "machine_id", *[F.try_divide(f"{m}_sum", f"{m}_n").alias(f"avg_{m}") for m in ("temperature", "vibration")],
        "anomaly_events", "total_events",
    )


def read_closed_hours(spark: SparkSession, path: str) -> DataFrame:
    return _averaged(BucketStore(spark, path, _OPEN).appended("closed", _HOURS))


def read_open_hours(spark: SparkSession, path: str) -> DataFrame:
    return _averaged(BucketStore(spark, path, _OPEN).read("open"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The readings that came too late for their hour, with the `batch` that brought them."""
    return BucketStore(spark, path, _OPEN).appended("late", LATE)
