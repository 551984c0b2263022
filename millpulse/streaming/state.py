"""State kept by a stream outside its checkpoint: one folder per batch, folded into a snapshot now and then."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_EVERY = 50  # batches


def store_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Store the rows of a batch; a retried batch replaces its folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batches/batch_id={batch_id}")


def snapshot_before(batch_id: int, every: int) -> int:
    """The last batch held by the newest snapshot that a batch may rely on, -1 for none.

    The snapshot of a round of batches is written by the last of them, so only later batches rely on it.
    """
    return batch_id // every * every - 1


def read_state(spark: SparkSession, path: str, batch_id: int, every: int = SNAPSHOT_EVERY) -> DataFrame:
    """Everything stored up to and with a batch, with its `batch_id`: the newest snapshot and the batches after it.

    At most `every` batch folders are read, named one by one, however many batches there have been.
    """
    last = snapshot_before(batch_id, every)
    parts = [_folder(spark, f"{path}/batches/batch_id={n}", n) for n in range(last + 1, batch_id + 1)]
    if last >= 0:
        parts.insert(0, spark.read.parquet(f"{path}/snapshots/upto={last}"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _folder(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.lit(batch_id).cast("long"))


def fold(
    spark: SparkSession, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame], every: int = SNAPSHOT_EVERY
) -> None:
    """After the last batch of a round, write what `merge` leaves of the state as a snapshot.

    `merge` keeps a `batch_id`. A retried batch writes the same snapshot again.
    """
    if (batch_id + 1) % every == 0:
        merge(read_state(spark, path, batch_id, every)).write.mode("overwrite").parquet(f"{path}/snapshots/upto={batch_id}")


def latest_batch(spark: SparkSession, path: str) -> int:
    """The newest stored batch; its folder name is all that is read."""
    found = spark.read.option("recursiveFileLookup", "false").parquet(f"{path}/batches").select("batch_id")
    return int(found.agg(F.max("batch_id")).first()[0])
