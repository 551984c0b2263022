"""Batches by size or age for any source: rows wait until enough have come or the oldest has waited long enough.

Spark starts a batch when a source has something, whatever it is. Here each of its batches is added to what waits. Full
batches of exactly `max_records` are flushed as often as there are enough rows; what is left is flushed when its oldest row is
`max_seconds` older than the newest row seen. Nothing is ever flushed empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.streaming.buckets import BucketStore, Kept

MAX_RECORDS, MAX_SECONDS = 10_000, 300


def in_one_order(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Add `position`, 0, 1, ... in the order of all rows, and how many there are; sorting and numbering stay spread over tasks.

    The other columns decide ties, so that equal rows only are interchangeable. The result is persisted.
    """
    total = [*order, *[c for c in rows.columns if c not in order]]
    ranged = rows.repartitionByRange(*total).withColumn("_part", F.spark_partition_id()).persist()
    counts = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}  # a number per task
    starts, n = [], 0
    for part in sorted(counts):
        starts += [F.lit(part), F.lit(n).cast("long")]
        n += counts[part]
    if not n:
        return ranged.withColumn("position", F.lit(0).cast("long")).drop("_part"), 0
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*total)) - 1
    return ranged.withColumn("position", F.create_map(*starts)[F.col("_part")] + place).drop("_part"), n


def admit(
    path: str, schema: str, clock: str, order: Sequence[str], max_records: int = MAX_RECORDS, max_seconds: float = MAX_SECONDS
) -> Callable[[DataFrame, int], None]:
    """A batch function that flushes by size or age below `path`; see `read_flushed`.

    `schema` names the columns, `clock` the one with the time of receipt, `order` those that rows are taken in. A batch may be
    repeated.
    """
    tables = {"waiting": Kept(schema, clock, lambda rows: rows)}

    def take(batch: DataFrame, batch_id: int) -> None:
        store = BucketStore(batch.sparkSession, path, tables, 1, 1, batch_id)
        waiting = store.read("waiting")
        rows, n = in_one_order(waiting.unionByName(batch.select(waiting.columns)), order)
        flushes, now = store.facts.get("flushes", 0), store.facts.get("now")
        full = n // max_records
        rest = F.col("position") >= full * max_records
        newest, oldest = rows.agg(F.max(clock), F.min(F.when(rest, F.col(clock)))).first()
        newest = max([t for t in (datetime.fromisoformat(now) if now else None, newest) if t], default=None)
        timed_out = oldest is not None and (newest - oldest).total_seconds() >= max_seconds
        number = F.least(F.floor(F.col("position") / max_records), F.lit(full)) + flushes
        reason: Column = F.when(rest, "age").otherwise("records")
        out = rows if timed_out else rows.where(~rest)
        store.append("flushed", out.withColumns({"flush": number.cast("long"), "reason": reason}).drop("position"))
        store.put("waiting", rows.where(rest & F.lit(not timed_out)).drop("position"), [0], replace=True)
        store.commit(flushes=flushes + full + timed_out, now=newest.isoformat() if newest else None)

    return take


def read_flushed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All flushed rows with the number of their `flush`, counted from 0, and its `reason`: records or age."""
    return BucketStore(spark, path, {}).appended("flushed", f"{schema}, flush long, reason string").drop("batch")


def read_waiting(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return BucketStore(spark, path, {"waiting": Kept(schema, "flush", lambda rows: rows)}).read("waiting")
