"""Extracts, typed tables, views and written results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse import schemas

# Headed CSV with cells as they are: blanks kept, quotes doubled, times to the microsecond.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    """A database table; give partitionColumn, bounds and numPartitions to read it in parallel."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


EXPORT_RECORDS = 500_000  # rows of one exported file; a file is loaded by one task


def extract_table_to_csv(source: DataFrame, name: str, columns: Sequence[str], out: str, run: str) -> str:
    """Write the named columns as headed CSV under a name that is unique per run.

    A repeated run replaces its own output; a later run never rewrites an earlier one, so a load
    that remembers files does not read the same rows again.
    """
    path = f"{out}/{name}_{run}.csv"
    rows = source.select(*columns).write.mode("overwrite").option("maxRecordsPerFile", EXPORT_RECORDS)
    rows.options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def create_tables(spark: SparkSession, root: str, tables: Mapping[str, object] = schemas.RAW_TABLES) -> None:
    """Create each table as empty Parquet unless it exists."""
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/{name}")


def with_default_now(rows: DataFrame, table: str) -> DataFrame:
    """Fill the time columns that default to now."""
    for column in schemas.DEFAULT_NOW.get(table, []):
        rows = rows.withColumn(column, F.coalesce(F.col(column), F.current_timestamp()))
    return rows


def register_models(models: Mapping[str, DataFrame]) -> None:
    """Expose each model to SQL as a view."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def write_artifacts(results: Mapping[str, DataFrame], out: str) -> None:
    """Write result tables as headed CSV."""
    for name, df in results.items():
        df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(f"{out}/{name}.csv")


def save_table(df: DataFrame, path: str, day_of: str | None = None) -> DataFrame:
    """Write a table once and return it as read back, so later steps start from the stored rows.

    With `day_of` the rows are stored by the day of that column for pruning. They are rebalanced by day first, so a
    day is one file, or a few when it is large, and not one per task.
    """
    writer = df
    if day_of is not None:
        writer = df.withColumn("day", F.to_date(day_of)).hint("rebalance", "day")
    out = writer.write.mode("overwrite")
    (out.partitionBy("day") if day_of is not None else out).parquet(path)
    return df.sparkSession.read.parquet(path)
