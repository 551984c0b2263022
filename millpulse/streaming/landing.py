"""Land parsed messages as files under year=/month=/day= folders."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millpulse.sources import landed_csv

SENSOR_FIELDS = ("timestamp", "machine_id", "temperature", "vibration")
ERROR_FIELDS = ("raw_message", "parse_error", "ingested_at")
FLUSH_SECONDS = 300
MAX_COLUMNS = 2_000  # of one batch of CSV files
DAY_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}


def with_landing_day(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Zero-padded year, month and day of the landing time (UTC), or of another time."""
    at = F.current_timestamp() if at is None else at
    return rows.withColumns({name: F.date_format(at, fmt) for name, fmt in DAY_PARTS.items()})


def land_stream(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    fields: Sequence[str] | None = None,
    by: Column | None = None,
    flush_seconds: int = FLUSH_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start landing `parsed` messages (see `parse_messages`).

    JSON keeps whole records, or only the named `fields`: each message, or its error record, is one line of
    text, and the file sink commits each batch exactly once. CSV writes each batch under the union of its keys
    and commits it exactly once too; read it with `load_landed_csv`. The size of a batch is set at the source,
    see `batch_limits`.
    """
    if fmt not in ("json", "csv"):
        raise ValueError("fmt must be 'json' or 'csv'")
    if flush_seconds <= 0:
        raise ValueError("flush_seconds must be positive")
    rows = with_landing_day(parsed, by)
    if fmt == "json":
        line = record_json(fields).alias("value")
        sink = rows.select(line, *DAY_PARTS).writeStream.format("text").partitionBy(*DAY_PARTS).option("path", path)
    else:
        sink = rows.select("payload", *ERROR_FIELDS, *DAY_PARTS).writeStream.foreachBatch(union_writer(path, stream_name(checkpoint)))
    sink = sink.option("checkpointLocation", checkpoint).outputMode("append")
    sink = sink.trigger(availableNow=True) if available_now else sink.trigger(processingTime=f"{flush_seconds} seconds")
    return sink.start()


def stream_name(checkpoint: str) -> str:
    """A stream is told apart from others by its checkpoint: a stream that starts over there counts its batches on."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def record_json(fields: Sequence[str] | None = None) -> Column:
    """The message as JSON text with all its keys, or the named ones it has; else its error record."""
    record = F.to_json("payload")
    if fields is not None:
        record = F.to_json(F.struct(*[F.try_variant_get("payload", f"$.{name}", "variant").alias(name) for name in fields]))
    return F.when(F.col("parse_error").isNull(), record).otherwise(F.to_json(F.struct(*ERROR_FIELDS)))


def union_writer(path: str, stream: str) -> Callable[[DataFrame, int], None]:
    """A batch writer whose columns are the sorted union of the batch's keys; `stream` tells streams into one folder apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # In a stream this is the query's own copy of the session.
        conf = batch.sparkSession.conf
        case_sensitive = conf.get("spark.sql.caseSensitive")
        day = F.concat_ws("/", *[F.concat(F.lit(f"{part}="), F.col(part)) for part in DAY_PARTS])
        records = batch.select(record_map().alias("record"), day.alias("day")).persist()
        try:
            # Key names become the header of the files; messages that use ids as keys would make it endless.
            found = records.select(F.explode(F.map_keys("record")).alias("key")).distinct().limit(MAX_COLUMNS + 1).collect()
            if len(found) > MAX_COLUMNS:
                raise ValueError(f"a batch has more than {MAX_COLUMNS} different keys; land it as JSON")
            keys = sorted(row.key for row in found)
            if not keys:
                return
            # Keys that differ only by case are different columns.
            conf.set("spark.sql.caseSensitive", "true")
            landed_csv.write_batch(records, path, f"{stream}-{batch_id}", keys, lambda key: csv_text(F.col("record")[key]))
        finally:
            conf.set("spark.sql.caseSensitive", case_sensitive)
            records.unpersist()

    return write


def record_map() -> Column:
    """The fields of a message, or of its error record, as a map."""
    error = F.to_json(F.struct(*ERROR_FIELDS))
    return F.coalesce(
        F.when(F.col("parse_error").isNull(), F.col("payload").try_cast("map<string,variant>")),
        F.try_parse_json(error).try_cast("map<string,variant>"),
    )


def csv_text(value: Column) -> Column:
    """A CSV cell: nothing for null, True/False for booleans, JSON for nested values."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double").cast("string"))
        .when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(value))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )
