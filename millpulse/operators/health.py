"""Hourly health, rolling features, baselines and risk: the mart rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions import rules
from millpulse.operators.status import attach_current_status, latest_status

HEALTH_COLUMNS = [
    "hour_ts", "machine_id", "avg_temperature", "avg_vibration",
    "anomaly_events", "total_events", "current_status",
]
RISK_COLUMNS = HEALTH_COLUMNS + [
    "rolling_mean_temp_3h", "rolling_std_temp_3h", "rolling_mean_vibration_3h", "rolling_std_vibration_3h",
    "temp_rate_of_change", "vibration_rate_of_change", "anomaly_rate_3h",
    "machine_temp_p95", "machine_vibration_p95", "temp_threshold_baseline", "vibration_threshold_baseline",
    "temp_threshold_breach", "vibration_threshold_breach", "machine_risk_score", "machine_risk_level",
]


def hourly_readings(sensor: DataFrame, temperature_limit: float = rules.MART_ANOMALY_TEMPERATURE) -> DataFrame:
    """One row per machine and hour. Tasks pre-aggregate, so a busy machine adds no shuffle volume."""
    return sensor.groupBy(rules.hour_of(F.col("event_ts")).alias("hour_ts"), "machine_id").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.avg("vibration").alias("avg_vibration"),
        F.sum(rules.anomaly_expr(F.col("temperature"), F.col("vibration"), temperature_limit)).alias("anomaly_events"),
        F.count(F.lit(1)).alias("total_events"),
    )


def machine_health_hourly(sensor: DataFrame, status: DataFrame) -> DataFrame:
    """Hourly readings with the current status of the machine; inputs are the staging views."""
    return attach_current_status(hourly_readings(sensor), latest_status(status)).select(HEALTH_COLUMNS)


def machine_baselines(hourly: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Exact interpolated 95th percentile of the hourly averages per machine.

    A machine has at most one distinct value per calendar hour, which bounds the state. With
    `accuracy` the percentile is approximate and returns an observed value instead.
    """
    def p95(column: str):
        if accuracy is None:
            return F.percentile(column, F.lit(rules.BASELINE_QUANTILE))
        return F.percentile_approx(column, rules.BASELINE_QUANTILE, accuracy)

    return hourly.groupBy("machine_id").agg(
        p95("avg_temperature").alias("machine_temp_p95"), p95("avg_vibration").alias("machine_vibration_p95")
    )


def rolling_features(health: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Three-row rolling means, population deviations and anomaly rate, and the change per row; `keep` names further columns."""
    # Rows of one hour differ only in status when a machine matches several status rows.
    by_hour = Window.partitionBy("machine_id").orderBy("hour_ts", "current_status")
    last3 = by_hour.rowsBetween(-2, 0)
    temperature, vibration = F.col("avg_temperature"), F.col("avg_vibration")
    return health.select(
        *HEALTH_COLUMNS,
        *keep,
        F.avg(temperature).over(last3).alias("rolling_mean_temp_3h"),
        F.coalesce(F.stddev_pop(temperature).over(last3), F.lit(0.0)).alias("rolling_std_temp_3h"),
        F.avg(vibration).over(last3).alias("rolling_mean_vibration_3h"),
        F.coalesce(F.stddev_pop(vibration).over(last3), F.lit(0.0)).alias("rolling_std_vibration_3h"),
        F.coalesce(temperature - F.lag(temperature).over(by_hour), F.lit(0.0)).alias("temp_rate_of_change"),
        F.coalesce(vibration - F.lag(vibration).over(by_hour), F.lit(0.0)).alias("vibration_rate_of_change"),
        F.coalesce(
            F.try_divide(F.sum("anomaly_events").over(last3), F.sum("total_events").over(last3)), F.lit(0.0)
        ).alias("anomaly_rate_3h"),
    )


def machine_risk_hourly(health: DataFrame) -> DataFrame:
    """Risk score and level per health row.

    The baseline is a window aggregate over the same partitioning as the rolling features, so the
    health rows are read once and no join is needed.
    """
    machine = Window.partitionBy("machine_id")
    quantile = F.lit(rules.BASELINE_QUANTILE)
    return score_risk(
        rolling_features(health)
        .withColumn("machine_temp_p95", F.percentile("avg_temperature", quantile).over(machine))
        .withColumn("machine_vibration_p95", F.percentile("avg_vibration", quantile).over(machine))
    )


def score_risk(featured: DataFrame) -> DataFrame:
    """Thresholds, breaches, score and level from rolling features and the machine's 95th percentiles."""
    scored = (
        featured
        .withColumn("temp_threshold_baseline", rules.threshold_expr(F.col("machine_temp_p95"), rules.MIN_TEMPERATURE_THRESHOLD))
        .withColumn("vibration_threshold_baseline", rules.threshold_expr(F.col("machine_vibration_p95"), rules.MIN_VIBRATION_THRESHOLD))
        .withColumn("temp_threshold_breach", rules.points_if(F.col("avg_temperature") > F.col("temp_threshold_baseline")))
        .withColumn("vibration_threshold_breach", rules.points_if(F.col("avg_vibration") > F.col("vibration_threshold_baseline")))
        .withColumn(
            "machine_risk_score",
            rules.risk_score_expr(
                F.col("temp_threshold_breach"), F.col("vibration_threshold_breach"),
                F.col("temp_rate_of_change"), F.col("vibration_rate_of_change"), F.col("anomaly_rate_3h"),
            ),
        )
        .withColumn("machine_risk_level", rules.risk_level_expr(F.col("machine_risk_score")))
    )
    return scored.select(RISK_COLUMNS)
