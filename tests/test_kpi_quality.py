from __future__ import annotations

from datetime import datetime

import pytest

from frames import START, at, ordered, rows, sensor, status
from millpulse.operators import health as hl
from millpulse.operators import kpi, quality
from millpulse.operators.orders import work_orders_status
from millpulse.plans.marts import build_models
from millpulse import schemas


def health(spark, readings, history=()):
    return hl.machine_health_hourly(sensor(spark, readings), status(spark, list(history)))


READINGS = [(0, "M-1", 80.0, 1.0), (60, "M-1", 95.0, 3.0), (60, "M-2", 70.0, 1.0), (120, "M-3", 70.0, 1.0)]
HISTORY = [("M-1", "RUNNING", 0), ("M-2", "IDLE", 0)]


def test_measures(spark):
    marts = health(spark, READINGS, HISTORY)
    risk = hl.machine_risk_hourly(marts)
    assert rows(kpi.kpi_availability(marts)) == [(50.0,)] and rows(kpi.kpi_status_coverage(marts)) == [(75.0,)]
    assert rows(kpi.kpi_high_risk_machines(risk)) == [(1,)] and rows(kpi.kpi_high_risk_machines(risk, 0.05)) == [(1,)]
    assert rows(kpi.kpi_avg_risk(risk)) == [(25.0,)]
    assert rows(kpi.kpi_rows_in_range(risk, at(60), at(120))) == [(2, 1)]
    assert rows(kpi.kpi_latest(marts)) == [(at(120), 70.0, 0)]
    assert ordered(kpi.status_distribution(marts)) == [("IDLE", 1, 25.0), ("RUNNING", 2, 50.0), ("UNKNOWN", 1, 25.0)]
    assert ordered(kpi.hourly_trend(marts), "avg_temperature") == [(70.0,), (80.0,), (82.5,)]
    assert rows(kpi.risk_by_machine(risk)) == [("M-1", 100), ("M-2", 0), ("M-3", 0)]
    assert ordered(kpi.risk_table(risk))[0] == ("M-1", "HIGH", 1, 1)
    assert ordered(kpi.anomalies_by_machine(sensor(spark, READINGS))) == [("M-1", 1, 2), ("M-2", 0, 1), ("M-3", 0, 1)]


def test_measures_of_nothing(spark):
    marts = health(spark, [])
    risk = hl.machine_risk_hourly(marts)
    assert rows(kpi.kpi_availability(marts)) == [(None,)] and rows(kpi.kpi_high_risk_machines(risk)) == [(0,)]
    assert rows(kpi.kpi_avg_risk(risk)) == [(None,)] and rows(kpi.kpi_rows_in_range(risk, START, at(9))) == [(0, 0)]
    for df in (kpi.kpi_latest(marts), kpi.status_distribution(marts), kpi.dim_hour(marts), kpi.hourly_trend(marts)):
        assert df.isEmpty()


def test_hour_dimension(spark):
    facts = health(spark, [(0, "A", 1.0, 1.0), (60 * 49 + 5, "A", 1.0, 1.0)])
    dim = kpi.dim_hour(facts)
    assert [r[0] for r in rows(dim.orderBy("hour_ts"), "hour_ts")] == [at(hours=h) for h in range(50)]
    assert rows(dim.orderBy("hour_ts").limit(1)) == [(START, START.date(), 2024, 3, 1, 0, 5)]
    assert kpi.with_dim_hour(facts).count() == 2


def orders(spark):
    data = [("1", "A", 5, "OPEN", at(0)), ("2", "A", None, None, at(1)), ("3", "A", 7, "OPEN", None), ("4", "A", 2, "OPEN", at(2)), ("5", None, 2, "OPEN", at(2))]
    return spark.createDataFrame(data, "order_id string, machine_id string, target_quantity int, order_status string, created_at timestamp_ntz")


def test_daily_orders(spark):
    daily = work_orders_status(orders(spark))
    assert ordered(daily) == sorted(
        [(START, "A", "OPEN", 2, 7), (START, "A", "UNKNOWN", 1, 0), (datetime(1970, 1, 1), "A", "OPEN", 1, 7)], key=repr
    )
    assert ordered(kpi.orders_by_machine_status(daily)) == [("A", "OPEN", 3), ("A", "UNKNOWN", 1)]
    assert rows(kpi.orders_by_machine_status(daily, ["OPEN", "DONE"])) == [("A", 3, 0)]


def test_single_checks(spark):
    data = orders(spark)
    assert rows(quality.dq_not_null(data, "created_at"), "order_id") == [("3",)]
    assert rows(quality.dq_unique(data.unionByName(data.limit(1)), "order_id")) == [("1", 2)]
    assert rows(quality.dq_unique(data.select("order_status"), "order_status")) == [("OPEN", 4)]
    assert rows(quality.dq_accepted_values(data, "order_status", ["DONE"])) == [("OPEN", 4)]
    assert ordered(quality.dq_range(data, "target_quantity", 3, 6), "order_id") == [("3",), ("4",), ("5",)]
    assert rows(quality.dq_not_all_unknown(health(spark, READINGS))) == [(4, 0)]
    assert quality.dq_not_all_unknown(health(spark, READINGS, HISTORY)).isEmpty() and quality.dq_not_all_unknown(health(spark, [])).isEmpty()


def test_all_checks_run_and_report(spark):
    raw = {
        "sensor_data_raw": sensor(spark, READINGS).withColumnRenamed("event_ts", "timestamp"),
        "machine_status_raw": spark.createDataFrame([], schemas.MACHINE_STATUS_RAW),
        "work_orders_raw": spark.createDataFrame([], schemas.WORK_ORDERS_RAW),
    }
    result = {(r.check_name, r.table_name, r.column_name): r.failures for r in quality.run_checks(build_models(raw)).collect()}
    assert len(result) == len(quality.MODEL_RULES)
    assert {key for key, n in result.items() if n} == {("not_all", "machine_health_hourly", "current_status")}


def test_unknown_check_is_refused():
    with pytest.raises(ValueError):
        quality.Rule("odd", "t", "c").failures()
