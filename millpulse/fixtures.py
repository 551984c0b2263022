"""Raw tables and messages mapped from the supplied events, lineitem and part tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.session import use_utc


ALARMS_SINCE = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream. The bracket makes the name a pattern, which also fits a folder of part files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


# A file that one task writes is read by many, one or more of these each.
ROW_GROUP_BYTES = {"parquet.block.size": str(4 << 20)}


def event_files(spark: SparkSession, sf_dir: str, folder: str, n: int = 3) -> DataFrame:
    """The events, in order of time, as a stream of `n` files that come in one batch each."""
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(n, "ts").write.options(**ROW_GROUP_BYTES).parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


BATCH_DAYS = (4, 5, 12, 20, 31)  # last day of January of each batch
STRAGGLERS = 16  # one event in so many comes a batch late


def event_batches(spark: SparkSession, sf_dir: str, folder: str, late: bool = False) -> DataFrame:
    """The events as a stream of files of uneven size, one batch each, in order of time or with stragglers."""
    events = table(spark, sf_dir, "events")
    batch = F.lit(0)
    for last_day in BATCH_DAYS[:-1]:
        batch = batch + (F.dayofmonth("ts") > last_day).cast("int")
    if late:
        batch = F.least(F.lit(len(BATCH_DAYS) - 1), batch + (F.col("event_id") % STRAGGLERS == 0).cast("int"))
    for n in range(len(BATCH_DAYS)):  # one after the other: a file stream goes by the age of files
        # Many tasks read and filter the events; one writes the file, which makes it one batch.
        events.where(batch == n).repartition(1).write.options(**ROW_GROUP_BYTES).mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def status_shared_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of several lines that share machine numbers, so that one machine matches many of them."""
    user, kind = F.col("user_id"), F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("L"), F.char((F.lit(65) + F.col("event_id") % 4).cast("int")), F.lit("-"), _text(user)).alias("machine_id"),
        F.when(kind == "error", " maintenance").when(kind == "view", "Idle").otherwise("RUNNING").alias("status"),
        F.col("ts").alias("last_updated"),
    )


def _text(number: Column) -> Column:
    return number.cast("string")


def _letter(user: Column) -> Column:
    return F.char((F.lit(65) + F.floor(user / 10) % 26).cast("int"))


def _padded(user: Column) -> Column:
    return F.concat(F.lit("M-"), F.lpad(_text(user), 4, "0"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def sensor_rows(events: DataFrame) -> DataFrame:
    """Sensor readings with their arrival number: ids with and without digits."""
    user = F.col("user_id")
    return events.select(
        F.col("ts").alias("timestamp"),
        F.when(user % 10 == 0, F.concat(F.lit("PRESS-"), _letter(user))).otherwise(_padded(user)).alias("machine_id"),
        (F.lit(70) + F.col("value") / 4).alias("temperature"),
        (F.lit(0.2) + _k() / F.lit(40.0)).alias("vibration"),
        F.col("event_id").alias("arrival"),
    )


def sensor_data_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_rows(table(spark, sf_dir, "events")).drop("arrival")


def sensor_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few machines with many readings per hour."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("D-"), F.lpad(_text(F.col("user_id") % 5), 3, "0")).alias("machine_id"),
        (F.lit(70) + F.col("value") / 8).alias("temperature"),
        (F.lit(0.2) + _k() / F.lit(55.0)).alias("vibration"),
    )


def machine_status_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy ids and statuses; users divisible by 7 have none."""
    user, kind = F.col("user_id"), F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .filter(user % 7 != 0)
        .select(
            F.when(user % 10 == 0, F.concat(F.lit(" press "), F.lower(_letter(user))))
            .when(user % 3 == 0, F.concat(F.lit(" m"), _text(user)))
            .otherwise(_padded(user))
            .alias("machine_id"),
            F.when(kind == "error", " maintenance").when(kind == "view", "Idle").otherwise("RUNNING").alias("status"),
            F.col("ts").alias("last_updated"),
        )
    )


def work_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per order, some without a time."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.concat(F.lit("WO-"), _text(F.col("l_orderkey"))).alias("order_id"),
        F.concat(F.lit("M-"), F.lpad(_text(F.col("l_suppkey")), 4, "0")).alias("machine_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("decimal(38,0)").alias("target_quantity"),
        F.when(F.col("l_linestatus") == "O", "OPEN").otherwise("IN_PROGRESS").alias("order_status"),
        F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("created_at"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "sensor_data_raw": sensor_data_raw(spark, sf_dir),
        "machine_status_raw": machine_status_raw(spark, sf_dir),
        "work_orders_raw": work_orders_raw(spark, sf_dir),
    }


def messages(events: DataFrame) -> DataFrame:
    """One message per event: sound ones and each kind of faulty one, chosen by event type."""
    user, kind = F.col("user_id"), F.col("event_type")
    machine = F.when(user % 10 == 0, F.concat(F.lit("PRESS-"), _letter(user))).otherwise(_padded(user))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    temperature, vibration = _text(F.lit(70) + F.col("value") / 4), _text(F.lit(0.2) + _k() / F.lit(40.0))

    def body(machine_json: Column, tail: Column) -> Column:
        return F.concat(F.lit('{"machine_id": '), machine_json, tail, F.lit("}"))

    quoted = F.concat(F.lit('"'), machine, F.lit('"'))
    # From a day on, sound messages carry a key that no table knows.
    alarm = F.when(F.col("ts") >= ALARMS_SINCE, F.concat(F.lit(', "alarm": "a'), _text(_k()), F.lit('"'))).otherwise("")
    full = F.concat(
        F.lit(', "timestamp": "'), stamp, F.lit('", "temperature": '), temperature, F.lit(', "vibration": '), vibration, alarm
    )
    text_and_no_time = F.concat(F.lit(', "temperature": " '), temperature, F.lit(' ", "vibration": true'))
    null_vibration = F.concat(
        F.lit(', "timestamp": "not a time", "temperature": '), temperature, F.lit(', "vibration": null')
    )
    broken = F.when(_k() < 40, F.concat(F.lit('{"machine_id": '), quoted)).when(_k() < 70, F.concat(F.lit("["), _text(_k()), F.lit("]"))).otherwise(
        body(quoted, F.lit(', "temperature": "hot"'))
    )
    return events.select(
        F.col("event_id").alias("arrival"),
        F.col("ts").alias("received_at"),
        F.when(kind == "error", broken)
        .when(kind == "signup", F.when(_k() < 50, body(F.lit('"  "'), full)).otherwise(body(quoted, full)))
        .when(kind == "view", body(quoted, text_and_no_time))
        .when(kind == "purchase", body(quoted, null_vibration))
        .otherwise(body(quoted, full))
        .cast("binary")
        .alias("body"),
    )
