"""A stored table with a primary key, whose upserts rewrite the files of the keys they touch and no others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.streaming.buckets import BUCKETS, BucketStore, Kept, newest


def _tables(schema: str, keys: Sequence[str]) -> dict[str, Kept]:
    return {"rows": Kept(schema, tuple(keys), newest(*keys))}


def upsert_table(path: str, updates: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Insert the updates, or replace the rows that have their keys; the buckets of the key that were written.

    The table is made by the first call. Buckets without an update keep their files. Readers see the table as it was until
    all is written. A key that is NULL, or occurs twice in the updates, fails before anything is written.
    """
    spark = updates.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema.fields)
    last = BucketStore(spark, path, _tables(schema, keys)).manifests
    store = BucketStore(spark, path, _tables(schema, keys), buckets, 0, last[-1] + 1 if last else 0)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    per_key = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    wrong = per_key.where(missing | (F.col("_n") > 1)).select(*keys).limit(1).collect()
    if wrong:
        raise ValueError(f"updates hold a key that is NULL or occurs more than once: {tuple(wrong[0])}")
    touched = store.touched(updates, tuple(keys))
    store.put("rows", updates, touched)
    store.commit(schema=schema, keys=list(keys))
    return touched


def read_table(spark: SparkSession, path: str) -> DataFrame:
    facts = BucketStore(spark, path, {}).facts
    return BucketStore(spark, path, _tables(facts["schema"], facts["keys"])).read("rows")
