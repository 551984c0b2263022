"""Intervals in which a machine stays above its temperature threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.functions import rules
from millpulse.operators.joins import DEFAULT_SALTS, salted_join


def sustained_breaches(
    enriched: DataFrame,
    baselines: DataFrame,
    min_minutes: float = rules.MIN_SUSTAINED_MINUTES,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Runs of consecutive breaching readings per machine, with their length and peak.

    A machine may hold a large share of all readings, so no step sorts a whole machine at once:

    1. readings are reduced to one row per machine and instant (calm readings come first there);
    2. runs are numbered inside each machine-minute by counting calm readings;
    3. only runs that touch an edge of their minute can continue in the next one. They are chained
       per machine (two rows per minute at most); runs inside a minute are already complete and
       stay spread over the minutes.

    A time without readings does not end a run; a calm or missing temperature does.
    """
    thresholds = baselines.select("machine_id", "temp_threshold_baseline", F.lit(True).alias("known"))
    flagged = salted_join(
        enriched.select("machine_id", "event_ts", "temperature"),
        thresholds, "machine_id", ["event_ts", "temperature"], "left", salts,
    ).withColumn(
        "threshold",
        F.when(F.col("known"), F.col("temp_threshold_baseline")).otherwise(F.lit(rules.MIN_TEMPERATURE_THRESHOLD)),
    )
    breach = F.coalesce(F.col("temperature") > F.col("threshold"), F.lit(False))
    instants = (
        flagged.groupBy("machine_id", "event_ts")
        .agg(
            F.count_if(~breach).alias("calm"),
            F.count_if(breach).alias("points"),
            F.max(F.when(breach, F.col("temperature"))).alias("max_temp"),
            F.max("threshold").alias("threshold"),
        )
        .withColumn("minute", F.date_trunc("minute", "event_ts"))
    )

    in_minute = Window.partitionBy("machine_id", "minute").orderBy("event_ts")
    numbered = (
        instants.withColumn("calm_before", F.sum("calm").over(in_minute.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last_instant", F.lead("event_ts").over(in_minute).isNull())
        .filter((F.col("points") > 0) | F.col("last_instant"))
    )
    pieces = numbered.groupBy("machine_id", "minute", "calm_before").agg(
        F.min(F.when(F.col("points") > 0, F.col("event_ts"))).alias("start"),
        F.max(F.when(F.col("points") > 0, F.col("event_ts"))).alias("end"),
        F.sum("points").alias("points"),
        F.max("max_temp").alias("max_temp"),
        F.max("threshold").alias("threshold"),
        F.max("last_instant").alias("at_end"),
    )

    at_edge = (F.col("calm_before") == 0) | F.col("at_end")
    chained = pieces.withColumn("inside", F.when(~at_edge, F.col("minute")))
    order = Window.partitionBy("machine_id", "inside").orderBy("minute", "calm_before")
    # The row before a minute's first run is the tail of the machine's previous minute.
    continues = (
        (F.col("calm_before") == 0)
        & (F.lag("minute").over(order) < F.col("minute"))
        & (F.lag("points").over(order) > 0)
    )
    runs = (
        chained.withColumn("_new", F.when(continues, 0).otherwise(1))
        .withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("points") > 0)
        .groupBy("machine_id", "inside", "run")
        .agg(
            F.min("start").alias("breach_start"),
            F.max("end").alias("breach_end"),
            F.sum("points").alias("breach_points"),
            F.max("max_temp").alias("max_temp"),
            F.max("threshold").alias("temp_threshold_baseline"),
        )
    )
    minutes = F.timestamp_diff("MICROSECOND", F.col("breach_start"), F.col("breach_end")) / F.lit(60_000_000.0)
    return runs.withColumn("breach_duration_minutes", minutes).select(
        "machine_id", "breach_start", "breach_end", "breach_points", "max_temp",
        "breach_duration_minutes", "temp_threshold_baseline",
        (F.col("breach_duration_minutes") >= min_minutes).alias("sustained_breach"),
    )
