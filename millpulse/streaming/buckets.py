"""Tables that a stream keeps up to date: rows by bucket of their key, one folder per batch and bucket, and a manifest.

A batch opens only the buckets it touches, adds a folder to each, and writes its manifest last; readers see what the newest
manifest names, so a batch counts as a whole or not at all. A retried batch replaces its folders and its manifest. When a
bucket has gathered `every` folders, the batch that touches it next writes its merged rows as one folder instead. Folders
that neither of the last two manifests names are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.sources import storage

BUCKETS = 64
MERGE_EVERY = 20  # folders of a bucket


@dataclass(frozen=True)
class Kept:
    """A kept table: its columns, the key columns that decide the bucket, and what is left of all its rows."""

    schema: str
    key: str | tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]


def newest(*keys: str) -> Callable[[DataFrame], DataFrame]:
    """Keep, per key, the rows of the batch that wrote it last."""

    def merge(rows: DataFrame) -> DataFrame:
        last = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
        return rows.withColumn("_rank", F.rank().over(last)).where("_rank = 1").drop("_rank")

    return merge


class BucketStore:
    """Kept tables below `path`, as they were before batch `batch_id`, or as they are now."""

    def __init__(
        self, spark: SparkSession, path: str, tables: Mapping[str, Kept], buckets: int = BUCKETS, every: int = MERGE_EVERY,
        batch_id: int | None = None,
    ):
        self.spark, self.path, self.tables, self.every, self.batch_id = spark, path.rstrip("/"), tables, every, batch_id
        found = [int(name) for name in storage.children(spark, f"{self.path}/manifests") if name.isdigit()]
        if batch_id is not None and any(n > batch_id for n in found):
            raise ValueError(f"{path} holds batch {max(found)}, which is later than {batch_id}: it belongs to another stream")
        self.manifests = sorted(n for n in found if batch_id is None or n < batch_id)
        held = self._manifest(self.manifests[-1]) if self.manifests else {"buckets": buckets, "folders": {}, "facts": {}}
        self.buckets, self.facts = held["buckets"], held["facts"]
        self.folders: dict[str, dict[str, list[int]]] = {name: dict(held["folders"].get(name, {})) for name in tables}

    def bucket(self, key: str | tuple[str, ...]) -> Column:
        return F.pmod(F.xxhash64(*([key] if isinstance(key, str) else key)), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, key: str | tuple[str, ...]) -> list[int]:
        """The buckets that rows fall into; at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(key)).distinct().collect())

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """What is left of a table, of all buckets or the named ones; only their folders are read."""
        kept = self.tables[table]
        wanted = self.folders[table].keys() if buckets is None else map(str, buckets)
        paths = [f"{self.path}/{table}/batch={n}/bucket={b}" for b in wanted for n in self.folders[table].get(b, [])]
        # The batch is read off the folder. As a literal it would make every batch compile its plans anew.
        schema = T.StructType.fromDDL(f"{kept.schema}, batch long")
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}")
        rows = reader.parquet(*paths).drop("bucket") if paths else self.spark.createDataFrame([], schema)
        return kept.merge(rows).drop("batch")

    def put(self, table: str, rows: DataFrame, buckets: Iterable[int] = (), replace: bool = False) -> None:
        """Add the rows of this batch. Name the `buckets` that they may fall into, so that full ones can be merged.

        With `replace` the rows are all that these buckets hold from now on.
        """
        kept, own = self.tables[table], self.folders[table]
        columns = T.StructType.fromDDL(kept.schema).fieldNames()
        added = rows.select(*columns)
        full = [b for b in buckets if replace or len(own.get(str(b), [])) >= self.every]
        if full and not replace:
            is_full = self.bucket(kept.key).isin(full)
            old, new = self.read(table, full).withColumn("batch", F.lit(0)), added.where(is_full).withColumn("batch", F.lit(1))
            added = added.where(~is_full).unionByName(kept.merge(old.unionByName(new)).select(*columns))
        folder = f"{self.path}/{table}/batch={self.batch_id}"
        # Rows of a bucket meet before they are written, so it gets one file, or a few when it is large.
        dealt = added.withColumn("bucket", self.bucket(kept.key)).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        for b in full:
            own.pop(str(b), None)
        for name in storage.children(self.spark, folder):
            if name.startswith("bucket="):
                bucket = name.removeprefix("bucket=")
                own[bucket] = [*own.get(bucket, []), self.batch_id]

    def append(self, output: str, rows: DataFrame) -> None:
        """Add rows to an output that only grows, in the folder of this batch."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{output}/batch={self.batch_id}")

    def appended(self, output: str, schema: str) -> DataFrame:
        """The rows of an output from every batch that counts, with the `batch`."""
        full = T.StructType.fromDDL(f"{schema}, batch long")
        if not self.manifests or not storage.children(self.spark, f"{self.path}/{output}"):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(f"{self.path}/{output}").where(F.col("batch") <= self.manifests[-1])

    def commit(self, **facts: object) -> None:
        """Make this batch count, with small facts to remember, and remove what no longer does."""
        self.facts |= facts
        manifest = {"buckets": self.buckets, "folders": self.folders, "facts": self.facts}
        storage.write_json(self.spark, f"{self.path}/manifests/{self.batch_id:012d}", manifest)
        if len(self.manifests) > 1:
            old, previous = self._manifest(self.manifests[-2]), self._manifest(self.manifests[-1])
            for table, bucket, n in _named(old) - _named(previous) - _named(manifest):
                storage.remove(self.spark, f"{self.path}/{table}/batch={n}/bucket={bucket}")
            for number in self.manifests[:-1]:
                storage.remove(self.spark, f"{self.path}/manifests/{number:012d}")

    def _manifest(self, number: int) -> dict:
        return storage.read_json(self.spark, f"{self.path}/manifests/{number:012d}")


def _named(manifest: dict) -> set[tuple[str, str, int]]:
    return {(table, bucket, n) for table, buckets in manifest["folders"].items() for bucket, ns in buckets.items() for n in ns}


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
