"""The exploratory run: recent readings to baselines, breaches, ranking and a summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from millpulse.operators import exploration as ex
from millpulse.operators.breaches import sustained_breaches
from millpulse.sources.tables import save_table, write_artifacts


def run_exploration(raw: DataFrame, as_of: datetime, work: str, out: str, days: int = 7) -> dict[str, DataFrame]:
    """Compute and store every exploratory table. Hourly features are stored once and reused.

    `top` is the machine of highest risk and `trend` its temperature beside its threshold. Without recent readings there
    is nothing to explore, which is an error.
    """
    enriched = ex.enrich_sensor(ex.recent_sensor(raw, as_of, days))
    if enriched.isEmpty():
        raise LookupError(f"no readings in the {days} days before {as_of}")
    hourly = save_table(ex.eda_rolling_features(ex.hourly_features_filled(enriched)), f"{work}/hourly_features")
    baselines = save_table(ex.eda_baselines(hourly), f"{work}/baselines")
    breaches = save_table(sustained_breaches(enriched, baselines), f"{work}/breaches")
    ranking = ex.risk_ranking(hourly, baselines)
    top = ex.top_machine(ranking)
    trend = ex.threshold_trend(hourly, baselines, top.first()["machine_id"])
    write_artifacts(
        {
            "machine_baseline_summary": baselines,
            "sustained_temp_breach_events": breaches,
            "machine_risk_ranking": ranking,
        },
        out,
    )
    return {
        "hourly": hourly,
        "baselines": baselines,
        "breaches": breaches,
        "ranking": ranking,
        "top": top,
        "trend": trend,
        "scatter": ex.scatter_data(hourly),
        "correlation": ex.correlation_matrix(hourly),
        "summary": ex.eda_summary(enriched, breaches, hourly),
    }
