"""Placement by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table and the shards take turns claiming their
next free slot. Every shard so owns the same number of slots, give or take one, and adding or removing a shard
moves few rows. A row's slot is a hash of its key, its shard one look into the broadcast table.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1_000_003  # at most 16 MB as a broadcast


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.sha256(name.encode()).digest()
    first, step = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:16], "big")
    return first % size, step % (size - 1) + 1


def slot_owners(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The number of the shard that owns each slot. More shards than slots, or a size that is not prime, is an error."""
    if not _is_prime(size) or size > MAX_TABLE_SIZE:
        raise ValueError(f"the table size must be a prime of at most {MAX_TABLE_SIZE}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards need distinct names, and no more of them than slots")
    at, step = map(list, zip(*(_preference(name, size) for name in shards)))
    owner = [-1] * size
    claimed = 0
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            owner[at[shard]] = shard
            claimed += 1
            if claimed == size:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The table as rows (slot, shard); `size` bounds what is broadcast."""
    text = ",".join(map(str, slot_owners(shards, size)))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))


def place(
    rows: DataFrame, keys: list[str], shards: list[str], size: int = TABLE_SIZE, spread_by: list[str] | None = None
) -> DataFrame:
    """The rows with their `slot` and `shard`; nothing is shuffled.

    Rows of equal keys share a shard. Rows whose keys are all NULL would share one slot, so they are placed by the
    hash of the whole row. `spread_by` names further columns to hash when one key may hold much of the input.
    Columns named slot or shard are replaced.
    """
    rows = rows.drop("slot", "shard")
    known = reduce(or_, [F.col(k).isNotNull() for k in keys])
    by_key = F.xxhash64(*[F.col(k) for k in keys], *[F.col(c) for c in spread_by or []])
    slot = F.pmod(F.when(known, by_key).otherwise(F.xxhash64(*[F.col(c) for c in rows.columns])), F.lit(size))
    return rows.withColumn("slot", slot).join(F.broadcast(lookup_table(rows.sparkSession, shards, size)), "slot", "left")


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder per shard. Rows are rebalanced by shard, so a large shard is written by several tasks."""
    rows.hint("rebalance", "shard").write.partitionBy("shard").mode("errorifexists").parquet(path)
