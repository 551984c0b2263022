"""Small frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2024, 3, 1)


def at(minutes: float = 0, hours: float = 0) -> datetime:
    return START + timedelta(minutes=minutes, hours=hours)


def sensor(spark, rows):
    """(minutes, machine, temperature, vibration) rows as cleaned readings."""
    return spark.createDataFrame(
        [(at(m) if not isinstance(m, datetime) else m, i, t, v) for m, i, t, v in rows],
        "event_ts timestamp_ntz, machine_id string, temperature double, vibration double",
    )


def raw_sensor(spark, rows):
    return sensor(spark, rows).withColumnRenamed("event_ts", "timestamp")


def status(spark, rows):
    """(machine, status, minutes or None) rows as cleaned status history."""
    return spark.createDataFrame(
        [(i, s, None if m is None else at(m)) for i, s, m in rows],
        "machine_id string, status string, status_ts timestamp_ntz",
    )


def one(spark, **values):
    """A single row with the given values."""
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value if not isinstance(value, (int, float, str)) else F.lit(value))
    return df


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def ordered(df, *columns):
    return sorted(rows(df, *columns), key=repr)
