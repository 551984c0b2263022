from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from frames import START, at, ordered, raw_sensor, rows, sensor
from millpulse.operators import exploration as ex
from millpulse.operators.breaches import sustained_breaches

NO_BASELINES = "machine_id string, temp_threshold_baseline double"


def enriched(spark, readings):
    return ex.enrich_sensor(raw_sensor(spark, readings))


def test_enriching_trims_all_white_space_only(spark):
    got = ordered(enriched(spark, [(0, "\t m#1 \n", 85.0, 2.0), (1, "b", 85.01, None), (2, None, 99.0, 1.0)]), "machine_id", "anomaly_flag")
    assert got == [("B", 1), ("M#1", 0)]


def test_recent_readings(spark):
    raw = raw_sensor(spark, [(at(hours=0), "A", 1.0, 1.0), (at(hours=25), "A", 2.0, 1.0)])
    assert rows(ex.recent_sensor(raw, START + timedelta(days=8), 7), "temperature") == [(2.0,)]


def test_empty_hours_are_kept(spark):
    filled = ex.hourly_features_filled(enriched(spark, [(0, "A", 80.0, 1.0), (180, "A", 90.0, 1.0), (0, "B", 70.0, 1.0)]))
    features = ex.eda_rolling_features(filled).filter("machine_id = 'A'").orderBy("hour_ts").collect()
    assert [r.hour_ts for r in features] == [at(60 * h) for h in range(4)]
    assert [r.avg_temperature for r in features] == [80.0, None, None, 90.0]
    assert [r.total_events for r in features] == [1, 0, 0, 1] and [r.anomaly_flag_rate for r in features] == [0.0, 0.0, 0.0, 1.0]
    assert features[3].temp_rate_of_change == 0.0 and features[2].rolling_mean_temp_3h == 80.0
    assert features[3].rolling_mean_temp_3h == 90.0 and features[3].rolling_std_temp_3h == 0.0


def test_long_gaps_are_filled_hour_by_hour(spark):
    filled = ex.hourly_features_filled(enriched(spark, [(0, "A", 80.0, 1.0), (60 * 24 * 40 + 300, "A", 90.0, 1.0)]))
    hours = [r[0] for r in filled.orderBy("hour_ts").select("hour_ts").collect()]
    assert hours == [at(hours=h) for h in range(24 * 40 + 6)]


def test_sample_deviation(spark):
    filled = ex.hourly_features_filled(enriched(spark, [(60 * h, "A", t, 1.0) for h, t in enumerate([80.0, 82.0, 87.0, 88.0])]))
    last = ex.eda_rolling_features(filled).orderBy(F.desc("hour_ts")).first()
    assert last.rolling_std_temp_3h == pytest.approx((((82 - 257 / 3) ** 2 + (87 - 257 / 3) ** 2 + (88 - 257 / 3) ** 2) / 2) ** 0.5)


def brute_force_runs(readings, threshold):
    """Row by row: calm readings before breaching ones at the same instant."""
    runs = []
    for machine in sorted({r[1] for r in readings}):
        mine = [(r[0], r[2] is not None and r[2] > threshold[machine], r[2]) for r in readings if r[1] == machine]
        current = None
        for ts, breach, temperature in sorted(mine, key=lambda r: (r[0], r[1])):
            if not breach:
                current = None
            elif current is None:
                current = [machine, ts, ts, 1, temperature]
                runs.append(current)
            else:
                current[2], current[3], current[4] = ts, current[3] + 1, max(current[4], temperature)
    return sorted([tuple(r) for r in runs], key=repr)


@pytest.mark.parametrize("seed, step", [(0, 7), (1, 40), (2, 200), (3, 3600)])
def test_runs_equal_brute_force(spark, seed, step):
    """Machine A holds most rows; instants repeat, runs cross minutes and span quiet hours."""
    rng = random.Random(seed)
    readings, hot = [], 0
    for _ in range(500):
        hot = hot if rng.random() < 0.8 else 1 - hot
        machine = "A" if rng.random() < 0.7 else rng.choice("BCD")
        ts = START + timedelta(seconds=rng.randrange(step * 60))
        for _ in range(rng.choice([1, 1, 1, 3])):
            readings.append((ts, machine, None if rng.random() < 0.05 else 95.0 + rng.random() if hot else 80.0, 1.0))
    baselines = spark.createDataFrame([("A", 90.0), ("B", 95.5), ("C", 60.0)], NO_BASELINES)
    threshold = {"A": 90.0, "B": 95.5, "C": 60.0, "D": 85.0}
    got = sustained_breaches(sensor(spark, readings), baselines, salts=4)
    assert ordered(got, "machine_id", "breach_start", "breach_end", "breach_points", "max_temp") == brute_force_runs(readings, threshold)


def test_islands_by_hand(spark):
    temperatures = [80.0, 95.0, 96.0, 80.0, 95.0, None, 97.0]
    runs = sustained_breaches(
        sensor(spark, [(n, "A", t, 1.0) for n, t in enumerate(temperatures)]), spark.createDataFrame([], NO_BASELINES)
    ).orderBy("breach_start").collect()
    assert [(r.breach_points, r.breach_duration_minutes, r.max_temp) for r in runs] == [(2, 1.0, 96.0), (1, 0.0, 95.0), (1, 0.0, 97.0)]


def test_sustained_limit(spark):
    nearly = [(0, "A", 95.0, 1.0), (14 + 59 / 60, "A", 95.0, 1.0)]
    enough = [(0, "B", 95.0, 1.0), (15, "B", 95.0, 1.0)]
    runs = sustained_breaches(sensor(spark, nearly + enough), spark.createDataFrame([], NO_BASELINES))
    assert ordered(runs, "machine_id", "sustained_breach") == [("A", False), ("B", True)]


def test_known_machine_without_threshold_never_breaches(spark):
    baselines = spark.createDataFrame([("A", None)], NO_BASELINES)
    assert sustained_breaches(sensor(spark, [(0, "A", 500.0, 1.0)]), baselines).isEmpty()


def features(spark, readings):
    return ex.eda_rolling_features(ex.hourly_features_filled(enriched(spark, readings)))


def test_ranking_orders_latest_hours_and_baselines_agree(spark):
    readings = [(60 * h, m, t + h, 1.0) for m, t in (("A", 70.0), ("B", 86.0), ("C", 70.0)) for h in range(4)]
    hourly = features(spark, readings)
    given = ex.risk_ranking(hourly, ex.eda_baselines(hourly))
    assert rows(given, "machine_id", "machine_risk_score") == [("B", 50), ("A", 0), ("C", 0)]
    assert sorted(map(str, given.select(sorted(given.columns)).collect())) == sorted(
        map(str, ex.risk_ranking(hourly).select(sorted(given.columns)).collect())
    )
    assert rows(ex.top_machine(given)) == [("B", 50, "MEDIUM")]


def test_correlation_of_constant_and_varying_columns(spark):
    hourly = features(spark, [(60 * h, "A", 70.0 + h, 1.0) for h in range(5)])
    cells = {(r.measure_x, r.measure_y): r.correlation for r in ex.correlation_matrix(hourly).collect()}
    assert cells["avg_temperature", "avg_vibration"] is None and cells["avg_vibration", "avg_vibration"] is None
    assert cells["avg_temperature", "avg_temperature"] == 1.0
    rising = features(spark, [(60 * h, "A", 70.0 + h, 1.0 - h) for h in range(5)])
    cells = {(r.measure_x, r.measure_y): r.correlation for r in ex.correlation_matrix(rising).collect()}
    assert cells["avg_temperature", "avg_vibration"] == pytest.approx(-1.0)


def test_trend_and_missing_machine(spark):
    hourly = features(spark, [(0, "A", 70.0, 1.0), (60, "A", 95.0, 1.0)])
    trend = ex.threshold_trend(hourly, ex.eda_baselines(hourly).filter("machine_id = 'B'"), "A")
    assert rows(trend, "avg_temperature", "temp_threshold") == [(70.0, 85.0), (95.0, 85.0)]
    ex.require_machine(hourly, "A")
    with pytest.raises(LookupError):
        ex.require_machine(hourly, "B")


def test_summary_of_readings_and_of_nothing(spark):
    def summary(readings):
        data = enriched(spark, readings)
        hourly = ex.hourly_features_filled(data)
        return rows(ex.eda_summary(data, sustained_breaches(data, ex.eda_baselines(hourly)), hourly))

    assert summary([(0, "A", 86.0, 1.0), (20, "A", 87.0, 1.0), (60, "A", 70.0, 1.0), (90, "A", 70.0, 1.0)]) == [(4, 2, 50.0, 1, None)]
    assert summary([]) == [(0, 0, 0.0, 0, None)]
