"""Tolerant loads of landed files into the raw tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse import schemas
from millpulse.functions.rules import not_nan
from millpulse.session import require_utc
from millpulse.sources.split_csv import read_split_csv

CORRUPT = "_corrupt_record"
LANDED_SENSOR_FILES = "year=*/month=*/day=*/*.{json,txt}"  # JSON lines come from the text sink
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# Positional columns behind one header line, optional double quotes. A quoted cell may hold line breaks, so the CSV
# reader takes one file in one task; `split_csv` reads a file by many. A row with too few or too many cells is kept:
# what is missing is NULL, what is too much is ignored.
CSV_OPTIONS = {
    "mode": "PERMISSIVE", "header": "true", "enforceSchema": "true", "quote": '"', "escape": '"', "multiLine": "true",
}


def text_schema(schema: T.StructType) -> T.StructType:
    """Every column as text, plus the column that receives unreadable records."""
    return T.StructType([*schemas.as_text(schema).fields, T.StructField(CORRUPT, T.StringType())])


def try_typed(text: Column, data_type: T.DataType) -> Column:
    """The text as the wanted type, NULL where it cannot be read. Offsets are resolved to UTC."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.try_to_timestamp(text).cast(data_type)
    if isinstance(data_type, T.DoubleType):
        return not_nan(text.try_cast("double"))
    if isinstance(data_type, T.StringType):
        return text
    return text.try_cast(data_type)


def typed_columns(schema: T.StructType) -> list[Column]:
    return [try_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]


def _load(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Readable records with typed columns; unreadable records are skipped.

    The condition also mentions a data column, because Spark refuses a file query, such as a plain
    count, that would read nothing but the column of unreadable records.
    """
    any_field = F.coalesce(F.col(schema.fieldNames()[0]), F.lit(""))
    return df.filter(F.concat(F.col(CORRUPT), any_field).isNull()).select(*typed_columns(schema))


def load_sensor_raw(spark: SparkSession, path: str, landed_since: date | None = None) -> DataFrame:
    """Landed sensor JSON (lines or one array per line) below year=/month=/day= folders.

    `landed_since` prunes the folders by landing day; it says nothing about the reading's own time.
    """
    landed = (
        require_utc(spark).read.schema(T.StructType([*text_schema(schemas.SENSOR_RAW).fields, *_day_fields()]))
        .options(**JSON_OPTIONS, basePath=path)
        .json(f"{path}/{LANDED_SENSOR_FILES}")
    )
    if landed_since is not None:
        day_number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
        landed = landed.filter(day_number >= int(landed_since.strftime("%Y%m%d")))
    return _load(landed, schemas.SENSOR_RAW)


def _day_fields() -> list[T.StructField]:
    return [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")]


def load_work_orders_raw(spark: SparkSession, path: str, trust_quotes: bool = False) -> DataFrame:
    """Work-order CSV exports by column position; see `read_split_csv`."""
    return _load_csv(spark, f"{path}/work_orders_*.csv", schemas.WORK_ORDERS_RAW, trust_quotes)


def load_machine_status_raw(spark: SparkSession, path: str, trust_quotes: bool = False) -> DataFrame:
    """Machine-status CSV exports by column position; see `read_split_csv`."""
    return _load_csv(spark, f"{path}/machine_status_*.csv", schemas.MACHINE_STATUS_RAW, trust_quotes)


def _load_csv(spark: SparkSession, files: str, schema: T.StructType, trust_quotes: bool) -> DataFrame:
    rows = read_split_csv(require_utc(spark), files, schemas.as_text(schema), CSV_OPTIONS, trust_quotes)
    return rows.select(*typed_columns(schema))
