"""Parse queue messages and validate sensor payloads. Works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.functions.coercion import finite, known_time, number_from_variant
from millpulse.functions.ids import strip_whitespace
from millpulse.session import accept_repeated_keys


def read_messages(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Message bodies from a stream source with a `value` column, such as kafka or text files."""
    stream = spark.readStream.format(fmt).options(**options).load(path)
    return stream.withColumnRenamed("value", "body")


def batch_limits(max_records: int = 10_000, max_delay_seconds: int = 300) -> dict[str, str]:
    """Kafka options that start a batch at so many records or after so many seconds."""
    return {
        "minOffsetsPerTrigger": str(max_records),
        "maxOffsetsPerTrigger": str(max_records),
        "maxTriggerDelay": f"{max_delay_seconds}s",
    }


def parse_messages(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add the parsed `payload`; a body that is no JSON object is kept as an error record.

    Error records carry `raw_message`, `parse_error` and `ingested_at`. Of a repeated key the last value counts.
    """
    accept_repeated_keys(messages.sparkSession)
    when = F.current_timestamp() if ingested_at is None else ingested_at
    text = F.make_valid_utf8(F.col("body").cast("string"))
    bad = F.col("parse_error").isNotNull()
    return (
        messages.withColumn("raw_message", text)
        .drop("body")
        .withColumn("_whole", parse_whole(F.col("raw_message")))
        .withColumn("payload", F.try_variant_get("_whole", "$[0]", "variant"))
        .withColumn("payload", F.when(F.try_variant_get("_whole", "$[1]", "long") == F.xxhash64("raw_message"), F.col("payload")))
        .drop("_whole")
        .withColumn(
            "parse_error",
            F.when(F.col("payload").isNull(), "invalid_json")
            .when(~F.schema_of_variant("payload").startswith("OBJECT"), "non_object_json"),
        )
        .withColumn("ingested_at", F.when(bad, F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")))
        .withColumn("raw_message", F.when(bad, F.col("raw_message")))
    )


def parse_whole(text: Column) -> Column:
    """The text and its own hash as a two-element JSON array, NULL when that is no JSON.

    The parser stops after the first complete value. With the hash behind the text, anything that
    follows the value in the text shows up as a missing or different second element.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]")))


def validate_payload(parsed: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Add the four typed sensor fields and `is_valid`.

    The machine id must be non-blank text and both numbers must be readable. A timestamp is kept as
    given when it names a time, otherwise the time of receipt takes its place.
    """
    when = F.current_timestamp() if received_at is None else received_at

    def text_of(value: str) -> Column:
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))

    fields = ("machine_id", "timestamp", "temperature", "vibration")
    # Each field is taken out of the payload once; what reads it refers to the column.
    taken = parsed.withColumns({f"_{name}_given": F.try_variant_get("payload", f"$.{name}", "variant") for name in fields})
    machine = F.nullif(strip_whitespace(text_of("_machine_id_given")), F.lit(""))
    given = text_of("_timestamp_given")
    now = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return (
        taken.withColumn("machine_id", machine)
        .withColumn("_temperature", number_from_variant(F.col("_temperature_given")))
        .withColumn("_vibration", number_from_variant(F.col("_vibration_given")))
        .withColumn("timestamp", F.when(known_time(given), given).otherwise(now))
        .withColumn("temperature", finite(F.col("_temperature")))
        .withColumn("vibration", finite(F.col("_vibration")))
        .withColumn(
            "is_valid",
            F.col("machine_id").isNotNull() & F.col("_temperature").isNotNull() & F.col("_vibration").isNotNull(),
        )
        .drop("_temperature", "_vibration", *[f"_{name}_given" for name in fields])
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows.

    The rows are kept by a generator, not a filter: a filter would be pushed below the projections
    and parse every body a second time.
    """
    def keep(condition: Column) -> DataFrame:
        return validated.select(F.inline(F.when(condition, F.array(F.struct("*")))))

    return keep(F.col("is_valid")), keep(~F.col("is_valid"))
