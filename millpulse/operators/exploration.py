"""Exploratory tables over raw readings: their rules differ from the marts on purpose.

The anomaly limit is lower, empty hours are kept, deviations are of the sample, and the score uses
the anomaly rate of the hour itself.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions import rules
from millpulse.functions.ids import strip_whitespace

CORRELATED = ("avg_temperature", "avg_vibration", "anomaly_flag_rate")


def recent_sensor(raw: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Readings of the last days. The limit is a literal, so it reaches the Parquet scan."""
    since = F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz")
    return raw.select("timestamp", "machine_id", "temperature", "vibration").filter(F.col("timestamp") >= since)


def enrich_sensor(raw: DataFrame) -> DataFrame:
    """Trimmed upper-case ids and the exploratory anomaly flag; rows without an id or time are dropped."""
    return raw.select(
        F.col("timestamp").alias("event_ts"),
        F.upper(strip_whitespace(F.col("machine_id"))).alias("machine_id"),
        "temperature",
        "vibration",
        rules.anomaly_expr(
            F.col("temperature"), F.col("vibration"), rules.EXPLORE_ANOMALY_TEMPERATURE
        ).alias("anomaly_flag"),
    ).filter(F.col("machine_id").isNotNull() & F.col("event_ts").isNotNull())


def hourly_features_filled(enriched: DataFrame) -> DataFrame:
    """One row per machine for every hour between its first and last reading.

    Each observed hour also emits the empty hours up to the next observed one, so no calendar table
    and no join are needed, and the rows stay partitioned by machine for the rolling features.
    """
    observed = enriched.groupBy(rules.hour_of(F.col("event_ts")).alias("hour_ts"), "machine_id").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.avg("vibration").alias("avg_vibration"),
        F.sum("anomaly_flag").alias("anomaly_events"),
        F.count(F.lit(1)).alias("total_events"),
    )
    by_hour = Window.partitionBy("machine_id").orderBy("hour_ts")
    last_empty = F.coalesce(F.lead("hour_ts").over(by_hour) - F.expr("INTERVAL 1 HOUR"), F.col("hour_ts"))
    # Days first, then hours, so that a stray year builds no very long array.
    filled = (
        observed.withColumn("_until", last_empty)
        .withColumn("_day", F.explode(F.sequence(F.col("hour_ts"), F.col("_until"), F.expr("INTERVAL 1 DAY"))))
        .withColumn("_day_end", F.least(F.col("_day") + F.expr("INTERVAL 23 HOURS"), F.col("_until")))
        .withColumn("_hour", F.explode(F.sequence(F.col("_day"), F.col("_day_end"), F.expr("INTERVAL 1 HOUR"))))
    )
    seen = F.col("_hour") == F.col("hour_ts")
    rate = F.coalesce(F.try_divide("anomaly_events", "total_events"), F.lit(0.0))
    return filled.select(
        F.col("_hour").alias("hour_ts"),
        "machine_id",
        F.when(seen, F.col("avg_temperature")).alias("avg_temperature"),
        F.when(seen, F.col("avg_vibration")).alias("avg_vibration"),
        F.when(seen, F.col("anomaly_events")).otherwise(F.lit(0)).alias("anomaly_events"),
        F.when(seen, F.col("total_events")).otherwise(F.lit(0)).alias("total_events"),
        F.when(seen, rate).otherwise(F.lit(0.0)).alias("anomaly_flag_rate"),
    )


def eda_rolling_features(filled: DataFrame) -> DataFrame:
    """Rolling three-hour mean and sample deviation, and the change per hour (0 when unknown)."""
    by_hour = Window.partitionBy("machine_id").orderBy("hour_ts")
    last3 = by_hour.rowsBetween(-2, 0)
    temperature, vibration = F.col("avg_temperature"), F.col("avg_vibration")
    return filled.select(
        "hour_ts", "machine_id", "avg_temperature", "avg_vibration",
        "anomaly_events", "total_events", "anomaly_flag_rate",
        F.avg(temperature).over(last3).alias("rolling_mean_temp_3h"),
        F.coalesce(F.stddev_samp(temperature).over(last3), F.lit(0.0)).alias("rolling_std_temp_3h"),
        F.avg(vibration).over(last3).alias("rolling_mean_vib_3h"),
        F.coalesce(F.stddev_samp(vibration).over(last3), F.lit(0.0)).alias("rolling_std_vib_3h"),
        F.coalesce(temperature - F.lag(temperature).over(by_hour), F.lit(0.0)).alias("temp_rate_of_change"),
        F.coalesce(vibration - F.lag(vibration).over(by_hour), F.lit(0.0)).alias("vib_rate_of_change"),
    )


def _with_thresholds(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "temp_threshold_baseline", rules.threshold_expr(F.col("machine_temp_p95"), rules.MIN_TEMPERATURE_THRESHOLD)
    ).withColumn(
        "vib_threshold_baseline", rules.threshold_expr(F.col("machine_vib_p95"), rules.MIN_VIBRATION_THRESHOLD)
    )


def eda_baselines(hourly: DataFrame) -> DataFrame:
    """Per-machine 95th percentiles and the thresholds that follow from them, over the hours with readings.

    Empty hours have no averages; leaving them out here keeps the filled grid out of the shuffle.
    """
    quantile = F.lit(rules.BASELINE_QUANTILE)
    return _with_thresholds(
        hourly.where("total_events > 0").groupBy("machine_id").agg(
            F.percentile("avg_temperature", quantile).alias("machine_temp_p95"),
            F.percentile("avg_vibration", quantile).alias("machine_vib_p95"),
        )
    )


def risk_ranking(hourly: DataFrame, baselines: DataFrame | None = None) -> DataFrame:
    """The latest hour of each machine with its score, worst first.

    Without given baselines they are window aggregates over the same partitioning as the rolling
    features, so the hourly rows are read and sorted once.
    """
    machine = Window.partitionBy("machine_id")
    rows = hourly.withColumn("_next", F.lead("hour_ts").over(machine.orderBy("hour_ts")))
    if baselines is None:
        quantile = F.lit(rules.BASELINE_QUANTILE)
        rows = rows.withColumn("machine_temp_p95", F.percentile("avg_temperature", quantile).over(machine)).withColumn(
            "machine_vib_p95", F.percentile("avg_vibration", quantile).over(machine)
        )
    newest = rows.filter(F.col("_next").isNull()).drop("_next")
    # A global sort first samples its input; without this small shuffle the sample would compute
    # the features a second time.
    newest = newest.repartition("machine_id", "hour_ts")
    newest = _with_thresholds(newest) if baselines is None else newest.join(baselines, "machine_id", "left")
    return (
        newest.withColumn("temp_threshold_breach", rules.points_if(F.col("avg_temperature") > F.col("temp_threshold_baseline")))
        .withColumn("vib_threshold_breach", rules.points_if(F.col("avg_vibration") > F.col("vib_threshold_baseline")))
        .withColumn(
            "machine_risk_score",
            rules.risk_score_expr(
                F.col("temp_threshold_breach"), F.col("vib_threshold_breach"),
                F.col("temp_rate_of_change"), F.col("vib_rate_of_change"), F.col("anomaly_flag_rate"),
            ),
        )
        .withColumn("machine_risk_level", rules.risk_level_expr(F.col("machine_risk_score")))
        .orderBy(F.col("machine_risk_score").desc(), F.col("avg_temperature").desc_nulls_last(), "machine_id")
    )


def top_machine(ranking: DataFrame) -> DataFrame:
    """The machine at the head of the ranking."""
    return (
        ranking.orderBy(F.col("machine_risk_score").desc(), F.col("avg_temperature").desc_nulls_last(), "machine_id")
        .limit(1)
        .select("machine_id", "machine_risk_score", "machine_risk_level")
    )


def correlation_matrix(hourly: DataFrame) -> DataFrame:
    """Pearson correlation of each pair of measures in long form, from one aggregate row."""
    cells = [(a, b) for a in CORRELATED for b in CORRELATED]
    wide = hourly.agg(*[
        (rules.pearson(F.col(a), F.col(b)) if a != b else F.when(F.stddev_pop(a) > 0, F.lit(1.0))).alias(f"{a}|{b}")
        for a, b in cells
    ])
    entries = [
        F.struct(F.lit(a).alias("measure_x"), F.lit(b).alias("measure_y"), F.col(f"{a}|{b}").alias("correlation"))
        for a, b in cells
    ]
    return wide.select(F.inline(F.array(*entries)))


def scatter_data(hourly: DataFrame, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """Points for the temperature against vibration chart; a fraction thins them for drawing."""
    points = hourly.select("machine_id", "hour_ts", *CORRELATED)
    return points if fraction is None else points.sample(fraction=fraction, seed=seed)


def threshold_trend(hourly: DataFrame, baselines: DataFrame, machine_id: str) -> DataFrame:
    """One machine's hourly temperature beside its threshold, in time order; an error for an unknown machine."""
    require_machine(hourly, machine_id)
    series = hourly.filter(F.col("machine_id") == machine_id).select("hour_ts", "machine_id", "avg_temperature")
    thresholds = baselines.filter(F.col("machine_id") == machine_id).select(
        "machine_id", F.col("temp_threshold_baseline").alias("known_threshold"), F.lit(True).alias("known")
    )
    threshold = F.when(F.col("known"), F.col("known_threshold")).otherwise(F.lit(rules.MIN_TEMPERATURE_THRESHOLD))
    return (
        series.join(thresholds, "machine_id", "left")
        .select("hour_ts", "machine_id", "avg_temperature", threshold.alias("temp_threshold"))
        .orderBy("hour_ts")
    )


def require_machine(hourly: DataFrame, machine_id: str) -> None:
    """Fail when the machine has no hourly rows."""
    if hourly.filter(F.col("machine_id") == machine_id).isEmpty():
        raise LookupError(f"no hourly rows for machine {machine_id}")


def eda_summary(enriched: DataFrame, breaches: DataFrame, hourly: DataFrame) -> DataFrame:
    """One row: readings, anomalies, their share, sustained breaches and the correlation."""
    # Three one-row aggregates side by side, folded into one row.
    parts = (
        enriched.agg(F.count(F.lit(1)).alias("total_rows"), F.coalesce(F.sum("anomaly_flag"), F.lit(0)).alias("anomaly_rows"))
        .unionByName(breaches.agg(F.count_if("sustained_breach").alias("sustained_count")), allowMissingColumns=True)
        .unionByName(
            hourly.agg(rules.pearson(F.col("avg_temperature"), F.col("avg_vibration")).alias("temp_vib_correlation")),
            allowMissingColumns=True,
        )
    )
    return parts.agg(
        F.max("total_rows").alias("total_rows"),
        F.max("anomaly_rows").alias("anomaly_rows"),
        F.coalesce(F.try_divide(F.max("anomaly_rows"), F.max("total_rows")) * 100.0, F.lit(0.0)).alias("anomaly_pct"),
        F.max("sustained_count").alias("sustained_count"),
        F.max("temp_vib_correlation").alias("temp_vib_correlation"),
    )
