"""Summaries of a load that add up with those of other loads: quantiles and distinct counts.

A sketch per machine and day takes a few kilobytes whatever the number of readings. Stored sketches of several loads are merged, not
recomputed, and a merged sketch is as good as one over all readings. The exact operators (`machine_baselines`,
`kpi_high_risk_machines`) need all rows at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.functions.rules import BASELINE_QUANTILE, day_of

QUANTILE_K = 400  # items of a quantile sketch's widest level
DISTINCT_LG_K = 12
MEASURES = ("temperature", "vibration")


def rank_error(k: int = QUANTILE_K) -> float:
    """How far, as a share of the readings, the rank of a quantile may be off, with 99 % confidence."""
    return 2.296 / k**0.9723


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def machine_day_sketches(readings: DataFrame, k: int = QUANTILE_K) -> DataFrame:
    """(day, machine_id, temperature_sketch, vibration_sketch) of one load."""
    return readings.groupBy(day_of(F.col("event_ts")).alias("day"), "machine_id").agg(
        *[F.kll_sketch_agg_double(m, F.lit(k)).alias(f"{m}_sketch") for m in MEASURES]
    )


def merged_quantiles(sketches: DataFrame, *by: str, quantile: float = BASELINE_QUANTILE) -> DataFrame:
    """The readings and the quantile of each measure per group of stored sketches, from any number of loads."""
    merged = sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(f"{m}_sketch").alias(m) for m in MEASURES])
    return merged.select(
        *by,
        *[F.kll_sketch_get_n_double(m).alias(f"{m}_n") for m in MEASURES],
        *[F.when(F.kll_sketch_get_n_double(m) > 0, F.kll_sketch_get_quantile_double(m, F.lit(quantile))).alias(f"{m}_quantile") for m in MEASURES],
    )


def day_machine_sketches(readings: DataFrame, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """(day, machines_sketch) of one load: which machines have reported."""
    return readings.groupBy(day_of(F.col("event_ts")).alias("day")).agg(F.hll_sketch_agg("machine_id", F.lit(lg_k)).alias("machines_sketch"))


def merged_machines(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many machines have reported, per group of stored sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("machines_sketch")).alias("machines"))
