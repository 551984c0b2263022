from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows, sensor, status
from millpulse.functions.ids import machine_key, machine_num
from millpulse.operators import health as hl
from millpulse.operators import status as st


def test_latest_status_puts_missing_times_first(spark):
    history = status(spark, [("M-1", "IDLE", 5), ("M1", "RUNNING", None), ("M-2", "IDLE", 1), ("M-2", "RUNNING", 2)])
    assert ordered(st.latest_status(history), "machine_key", "status") == [("M1", "RUNNING"), ("M2", "RUNNING")]


def test_join_arms_and_fan_out(spark):
    readings = sensor(spark, [(0, i, 80.0, 1.0) for i in ("M-1", "X-1", "PRESS", "M-00-1", "LONELY")])
    history = status(spark, [("M-1", "RUNNING", 1), ("X-1", "IDLE", 1), ("P-RESS", "MAINTENANCE", 1), ("Z-0", "IDLE", 1)])
    health = hl.machine_health_hourly(readings, history)
    assert ordered(health, "machine_id", "current_status") == sorted(
        [
            ("M-1", "RUNNING"), ("M-1", "IDLE"), ("X-1", "RUNNING"), ("X-1", "IDLE"),
            ("PRESS", "MAINTENANCE"), ("M-00-1", "IDLE"), ("LONELY", "UNKNOWN"),
        ],
        key=repr,
    )


def random_id(rng):
    if rng.random() < 0.1:
        return rng.choice("ABC") + "-" + "9" * 39
    letters = rng.choice(["A", "B", "AB", "-A-"])
    return letters + (rng.choice(["", "-"]) + str(rng.randrange(4)) if rng.random() < 0.7 else "") + rng.choice(["", "-"])


@pytest.mark.parametrize("seed", range(4))
def test_status_join_equals_the_or_join(spark, seed):
    rng = random.Random(seed)
    ids = [random_id(rng) for _ in range(60)]
    machines = spark.createDataFrame([(i,) for i in set(ids)], "machine_id string")
    history = status(spark, [(random_id(rng), rng.choice(["RUNNING", "IDLE"]), rng.randrange(100)) for _ in range(80)])
    latest = st.latest_status(history)

    left = machines.select("machine_id", machine_key(F.col("machine_id")).alias("k"), machine_num(F.col("machine_id")).alias("n"))
    n, m = F.col("n"), F.col("machine_num")
    condition = (n.isNotNull() & m.isNotNull() & (n == m)) | ((n.isNull() | m.isNull()) & (F.col("k") == F.col("machine_key")))
    expected = Counter(rows(left.join(latest, condition), "machine_id", "status"))

    got = Counter()
    for machine, state, copies in rows(st.status_matches(machines, latest)):
        got[(machine, state)] += copies
    assert got == expected


def test_coverage_and_backfill(spark):
    readings = sensor(spark, [(0, "M-1", 1.0, 1.0), (1, "M-1", 1.0, 1.0), (2, "M-2", 1.0, 1.0)])
    history = status(spark, [("M1", "IDLE", 0)])
    assert rows(st.key_coverage(readings, history)) == [(2, 1, 1)]
    filled = st.backfill_status(readings, history, "IDLE", at(0))
    assert ordered(filled) == sorted([("M1", "IDLE", at(0)), ("M-2", "IDLE", at(0))], key=repr)


def test_hourly_averages_skip_missing_values(spark):
    readings = sensor(spark, [(0, "A", 80.0, 1.0), (59, "A", None, 3.0), (60, "A", 91.0, None)])
    assert ordered(hl.hourly_readings(readings)) == [(at(0), "A", 80.0, 2.0, 1, 2), (at(60), "A", 91.0, None, 1, 1)]


def test_rolling_features_and_risk(spark):
    temperatures = [80.0, 82.0, None, 90.0]
    readings = sensor(spark, [(60 * h, "A", t, 1.0 + h) for h, t in enumerate(temperatures)])
    risk = hl.machine_risk_hourly(hl.machine_health_hourly(readings, status(spark, [])))
    got = {r.hour_ts: r for r in risk.collect()}
    second, third, fourth = (got[at(60 * h)] for h in (1, 2, 3))
    assert second.rolling_mean_temp_3h == 81.0 and second.rolling_std_temp_3h == 1.0 and second.temp_rate_of_change == 2.0
    assert third.temp_rate_of_change == 0.0 and third.temp_threshold_breach == 0
    assert fourth.rolling_mean_temp_3h == 86.0 and fourth.temp_rate_of_change == 0.0
    assert fourth.anomaly_rate_3h == pytest.approx(2 / 3)
    # p95 of 80, 82, 90 lies at position 1.9 of 0..2; of 1, 2, 3, 4 at 2.85 of 0..3.
    assert fourth.machine_temp_p95 == pytest.approx(89.2) and fourth.machine_vibration_p95 == pytest.approx(3.85)
    assert fourth.machine_risk_score == 35 + 25 + 10 + 15 and fourth.machine_risk_level == "HIGH"


def test_machine_without_readings_has_no_threshold(spark):
    risk = hl.machine_risk_hourly(hl.machine_health_hourly(sensor(spark, [(0, "A", None, None)]), status(spark, [])))
    row = risk.first()
    assert row.temp_threshold_baseline is None and row.temp_threshold_breach == 0 and row.machine_risk_level == "LOW"


def test_window_baselines_equal_grouped_baselines(spark):
    rng = random.Random(1)
    readings = sensor(spark, [(60 * h, f"M-{m}", rng.uniform(70, 100), rng.uniform(0, 3)) for m in range(5) for h in range(30)])
    health = hl.machine_health_hourly(readings, status(spark, []))
    risk = hl.machine_risk_hourly(health).select("machine_id", "machine_temp_p95", "machine_vibration_p95").distinct()
    assert ordered(risk) == ordered(hl.machine_baselines(health))


def test_empty_inputs_keep_their_schema(spark):
    health = hl.machine_health_hourly(sensor(spark, []), status(spark, []))
    assert health.columns == hl.HEALTH_COLUMNS and health.isEmpty()
    risk = hl.machine_risk_hourly(health)
    assert risk.columns == hl.RISK_COLUMNS and risk.isEmpty()
