"""Load validation, previews and upserts over the raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def freshness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, latest_event_ts) per table; each entry names its time column."""
    return _union([
        df.agg(F.max(column).alias("latest_event_ts")).select(F.lit(name).alias("table_name"), "latest_event_ts")
        for name, (df, column) in tables.items()
    ])


def latest_rows(df: DataFrame, ts_column: str, n: int = 10) -> DataFrame:
    """The n newest rows (NULL times first, as the warehouse sorts them), ties told apart by the other columns."""
    others = [F.col(c).asc_nulls_last() for c in df.columns if c != ts_column]
    return df.orderBy(F.col(ts_column).desc_nulls_first(), *others).limit(n)


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not updated, plus all updates.

    A key that occurs twice in the updates fails the job, as it would in the database. Updates are
    counted per key in partial aggregates, so a repeated key does not gather in one task.
    """
    values = [c for c in target.columns if c not in keys]
    message = F.concat(F.lit("updates hold the same key more than once: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    counted = updates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*values)).alias("_row")
    )
    single = F.col("_n") == 1
    checked = counted.select(*[
        F.when(single, F.col(f"_row.{c}")).otherwise(F.raise_error(message).cast(target.schema[c].dataType)).alias(c)
        if c in values else F.col(c)
        for c in target.columns
    ])
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(checked)
