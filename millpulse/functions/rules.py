"""Anomaly, threshold and risk rules shared by the marts and the exploratory tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules.
MART_ANOMALY_TEMPERATURE = 90.0
EXPLORE_ANOMALY_TEMPERATURE = 85.0
ANOMALY_VIBRATION = 2.0
MIN_TEMPERATURE_THRESHOLD = 85.0
MIN_VIBRATION_THRESHOLD = 2.0
BASELINE_QUANTILE = 0.95
TEMPERATURE_BREACH_POINTS = 35
VIBRATION_BREACH_POINTS = 25
TEMPERATURE_RISE = 1.5
TEMPERATURE_RISE_POINTS = 15
VIBRATION_RISE = 0.25
VIBRATION_RISE_POINTS = 10
HIGH_ANOMALY_RATE = 0.20
HIGH_ANOMALY_RATE_POINTS = 15
RAISED_ANOMALY_RATE = 0.10
RAISED_ANOMALY_RATE_POINTS = 8
MEDIUM_SCORE = 40
HIGH_SCORE = 70
MIN_SUSTAINED_MINUTES = 15
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def not_nan(value: Column) -> Column:
    """NaN as NULL: Spark orders NaN above every number, so it would pass each upper limit."""
    return F.when(~F.isnan(value), value)


def points_if(condition: Column, points: int = 1) -> Column:
    """`points` where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def anomaly_expr(
    temperature: Column,
    vibration: Column,
    temperature_limit: float = MART_ANOMALY_TEMPERATURE,
    vibration_limit: float = ANOMALY_VIBRATION,
) -> Column:
    return points_if((temperature > temperature_limit) | (vibration > vibration_limit))


def threshold_expr(p95: Column, minimum: float) -> Column:
    """The baseline, never below `minimum`, NULL for a machine without readings."""
    return F.when(p95.isNotNull(), F.greatest(F.lit(minimum), p95))


def risk_score_expr(
    temperature_breach: Column,
    vibration_breach: Column,
    temperature_change: Column,
    vibration_change: Column,
    anomaly_rate: Column,
) -> Column:
    """Additive score in 0..100."""
    rate_points = (
        F.when(anomaly_rate >= HIGH_ANOMALY_RATE, F.lit(HIGH_ANOMALY_RATE_POINTS))
        .when(anomaly_rate >= RAISED_ANOMALY_RATE, F.lit(RAISED_ANOMALY_RATE_POINTS))
        .otherwise(F.lit(0))
    )
    total = (
        points_if(temperature_breach == 1, TEMPERATURE_BREACH_POINTS)
        + points_if(vibration_breach == 1, VIBRATION_BREACH_POINTS)
        + points_if(temperature_change >= TEMPERATURE_RISE, TEMPERATURE_RISE_POINTS)
        + points_if(vibration_change >= VIBRATION_RISE, VIBRATION_RISE_POINTS)
        + rate_points
    )
    return F.least(F.lit(100), F.greatest(F.lit(0), total))


def risk_level_expr(score: Column) -> Column:
    low, medium, high = RISK_LEVELS
    return F.when(score >= HIGH_SCORE, high).when(score >= MEDIUM_SCORE, medium).otherwise(low)


def pearson(a: Column, b: Column) -> Column:
    """Correlation over rows where both sides are known; NULL when either side is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
