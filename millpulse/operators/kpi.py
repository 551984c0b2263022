"""Dashboard measures over the marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions import rules


def _percent(part: Column, whole: Column) -> Column:
    """NULL when there is nothing to divide by."""
    return F.try_divide(part, whole) * 100.0


def kpi_availability(health: DataFrame) -> DataFrame:
    """Share of machine-hours whose machine is running, in percent."""
    return health.agg(
        _percent(F.count_if(F.col("current_status") == "RUNNING"), F.count(F.lit(1))).alias("availability_pct")
    )


def kpi_status_coverage(health: DataFrame) -> DataFrame:
    """Share of machine-hours with a known status, in percent."""
    return health.agg(
        _percent(F.count_if(F.col("current_status") != "UNKNOWN"), F.count(F.lit(1))).alias("status_coverage_pct")
    )


def kpi_high_risk_machines(risk: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Machines with at least one HIGH hour; 0 when there is none."""
    machine = F.when(F.col("machine_risk_level") == "HIGH", F.col("machine_id"))
    counted = F.count_distinct(machine) if relative_error is None else F.approx_count_distinct(machine, relative_error)
    return risk.agg(F.coalesce(counted, F.lit(0)).alias("high_risk_machines"))


def kpi_avg_risk(risk: DataFrame) -> DataFrame:
    return risk.agg(F.avg("machine_risk_score").alias("avg_machine_risk_score"))


def kpi_rows_in_range(risk: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows and HIGH rows with start <= hour < end."""
    hour = F.col("hour_ts")
    inside = (hour >= F.lit(start).cast("timestamp_ntz")) & (hour < F.lit(end).cast("timestamp_ntz"))
    return risk.filter(inside).agg(
        F.count(F.lit(1)).alias("rows_in_range"),
        F.count_if(F.col("machine_risk_level") == "HIGH").alias("high_rows_in_range"),
    )


def kpi_latest(health: DataFrame) -> DataFrame:
    """Temperature (mean over machines) and anomalies (sum) of the latest hour."""
    per_hour = health.groupBy("hour_ts").agg(
        F.avg("avg_temperature").alias("latest_avg_temperature"), F.sum("anomaly_events").alias("latest_anomaly_events")
    )
    return per_hour.orderBy(F.col("hour_ts").desc()).limit(1)


def status_distribution(health: DataFrame) -> DataFrame:
    """Rows per current status and their share; the total runs over one row per status."""
    everything = Window.partitionBy(F.lit(1))
    counts = health.groupBy("current_status").agg(F.count(F.lit(1)).alias("status_rows"))
    return counts.withColumn("share_pct", _percent(F.col("status_rows"), F.sum("status_rows").over(everything)))


def orders_by_machine_status(orders: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """Order counts by machine and status; one column per status when the statuses are named."""
    if statuses is None:
        return orders.groupBy("machine_id", "order_status").agg(F.sum("order_count").alias("order_count"))
    return orders.groupBy("machine_id").pivot("order_status", statuses).agg(F.sum("order_count")).fillna(0)


def hourly_trend(health: DataFrame) -> DataFrame:
    """Mean temperature and vibration over machines per hour."""
    return health.groupBy("hour_ts").agg(
        F.avg("avg_temperature").alias("avg_temperature"), F.avg("avg_vibration").alias("avg_vibration")
    )


def risk_by_machine(risk: DataFrame) -> DataFrame:
    """The highest score each machine reached, worst first."""
    return (
        risk.groupBy("machine_id").agg(F.max("machine_risk_score").alias("machine_risk_score"))
        .repartition("machine_id", "machine_risk_score")  # the sort samples this, not the risk rows
        .orderBy(F.col("machine_risk_score").desc(), "machine_id")
    )


def risk_table(risk: DataFrame) -> DataFrame:
    return risk.select("machine_id", "machine_risk_level", "temp_threshold_breach", "vibration_threshold_breach")


def anomalies_by_machine(sensor: DataFrame) -> DataFrame:
    """Anomalous readings and all readings per machine."""
    flag = rules.anomaly_expr(F.col("temperature"), F.col("vibration"))
    return sensor.groupBy("machine_id").agg(F.sum(flag).alias("anomaly_events"), F.count(F.lit(1)).alias("total_events"))


def dim_hour(facts: DataFrame, hour_column: str = "hour_ts") -> DataFrame:
    """Every hour from the first to the last of the facts, with its date parts."""
    hour = F.col("hour_ts")
    # Years are spread over the tasks before days and hours are made, so that a stray year neither builds a very
    # long array nor leaves the calendar to one task.
    ends = facts.agg(F.min(hour_column).alias("first"), F.max(hour_column).alias("last"))
    years = ends.select("*", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("_year")).repartition("_year")
    start = F.make_timestamp_ntz("_year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.make_timestamp_ntz("_year", F.lit(12), F.lit(31), F.lit(23), F.lit(0), F.lit(0))
    day_range = F.sequence(F.greatest(rules.day_of(F.col("first")), start), F.least("last", end), F.expr("INTERVAL 1 DAY"))
    days = years.withColumn("day", F.explode(day_range))
    hours = days.withColumn(
        "hour_ts", F.explode(F.sequence(F.col("day"), F.col("day") + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR")))
    ).filter(hour.between(F.col("first"), F.col("last")))
    return hours.select("hour_ts", *_hour_parts(hour))


def _hour_parts(hour: Column) -> list[Column]:
    return [
        hour.cast("date").alias("hour_date"),
        F.year(hour).alias("year"),
        F.month(hour).alias("month"),
        F.dayofmonth(hour).alias("day"),
        F.hour(hour).alias("hour_of_day"),
        (F.weekday(hour) + 1).alias("iso_weekday"),
    ]


def with_dim_hour(facts: DataFrame) -> DataFrame:
    """Facts with the columns of the hour dimension.

    The date parts are functions of the hour, so they are computed in place and nothing is joined. Facts without an
    hour match no hour of the dimension and drop out.
    """
    hour = F.col("hour_ts")
    return facts.where(hour.isNotNull()).select("*", *_hour_parts(hour))
