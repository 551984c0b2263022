"""Load each landed file once into a raw Parquet table, and keep a ledger of what became of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millpulse import schemas
from millpulse.session import require_utc
from millpulse.sources import storage
from millpulse.sources.raw import CORRUPT, CSV_OPTIONS, JSON_OPTIONS, text_schema, typed_columns

ERROR_CHARS = 200  # of the first rejected record
LEDGER = "source_file string, rows_loaded long, rows_rejected long, first_error string, loaded_at timestamp"


def incremental_load(
    spark: SparkSession,
    files: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: str = "json",
    max_files: int | None = None,
    reject_ragged: bool = False,
) -> StreamingQuery:
    """Append new files to `target` and stop when there are none left; bad records never stop a load.

    The checkpoint remembers loaded files. Each batch writes its rows and its part of the ledger below a folder of its own and
    is committed last, so a batch that is retried counts once. Unreadable records go to their own partition. JSON records
    are unreadable when they do not parse; CSV records are kept with missing or surplus cells (see `CSV_OPTIONS`), unless
    `reject_ragged` asks for as many cells as columns.
    """
    reader = require_utc(spark).readStream.format(fmt)
    if fmt == "json":
        reader, rejected = reader.schema(text_schema(schema)).options(**JSON_OPTIONS), F.col(CORRUPT)
    elif reject_ragged:
        reader = reader.schema(text_schema(schema)).options(**CSV_OPTIONS, columnNameOfCorruptRecord=CORRUPT)
        rejected = F.col(CORRUPT)
    else:
        reader, rejected = reader.schema(schemas.as_text(schema)).options(**CSV_OPTIONS), F.lit(None).cast("string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    state = F.when(rejected.isNull(), "loaded").otherwise("rejected")
    rows = reader.load(files).select(
        *typed_columns(schema), rejected.alias("rejected_text"), F.col("_metadata.file_path").alias("source_file"), state.alias("load_state")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{target}/rows/batch={batch_id}"
        numbered = batch.withColumn("source_position", F.monotonically_increasing_id())
        numbered.write.mode("overwrite").partitionBy("load_state").parquet(folder)
        stored = batch.sparkSession.read.schema(_stored(schema)).parquet(folder)
        _ledger_of(stored).write.mode("overwrite").parquet(f"{target}/ledger/batch={batch_id}")
        storage.write_json(batch.sparkSession, f"{target}/commits/{batch_id}.json", {"batch": batch_id})

    query = (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _ledger_of(stored: DataFrame) -> DataFrame:
    bad = F.col("load_state") == "rejected"
    first = F.min_by(F.when(bad, F.left("rejected_text", F.lit(ERROR_CHARS))), F.when(bad, F.col("source_position")))
    return stored.groupBy("source_file").agg(
        F.count_if(~bad).alias("rows_loaded"), F.count_if(bad).alias("rows_rejected"), first.alias("first_error"),
        F.current_timestamp().alias("loaded_at"),
    )


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([
        *schema.fields, T.StructField("rejected_text", T.StringType()), T.StructField("source_file", T.StringType()),
        T.StructField("source_position", T.LongType()), T.StructField("load_state", T.StringType()),
    ])


def _committed(spark: SparkSession, target: str, part: str, schema: T.StructType) -> DataFrame:
    """What committed batches have written below a folder; nothing before the first load."""
    if not storage.children(spark, f"{target}/commits"):
        return spark.createDataFrame([], schema)
    commits = spark.read.schema("batch int").json(f"{target}/commits")
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{target}/{part}")
    return rows.join(commits, "batch", "left_semi").select(*schema.fieldNames())


def read_loaded(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The good rows of a loaded table; the rejected partition is not scanned."""
    return _committed(spark, target, "rows", _stored(schema)).filter("load_state = 'loaded'").select(*schema.fieldNames())


def read_rejected(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    return _committed(spark, target, "rows", _stored(schema)).filter("load_state = 'rejected'").select("rejected_text", "source_file")


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, rows_loaded, rows_rejected, first_error, loaded_at) of every file that held records, over all cycles."""
    return _committed(spark, target, "ledger", T.StructType.fromDDL(LEDGER))
