from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows, sensor
from millpulse.functions import rules
from millpulse.functions.coercion import two_decimals
from millpulse.functions.ids import machine_key, machine_num
from millpulse.operators.staging import stg_machine_status, stg_sensor_data, stg_work_orders


def test_machine_ids_are_cleaned_and_unusable_rows_dropped(spark):
    ids = [" m-001 ", "", "  ", "m#1", "###", None]
    raw = spark.createDataFrame(
        [(at(n), i, 1.0, 1.0) for n, i in enumerate(ids)] + [(None, "M-9", 1.0, 1.0)],
        "timestamp timestamp_ntz, machine_id string, temperature double, vibration double",
    )
    assert ordered(stg_sensor_data(raw), "machine_id") == [("M-001",), ("M1",)]


def test_statuses_keep_letters_and_underscores(spark):
    raw = spark.createDataFrame(
        [("m-1", " in progress1", at(1)), ("m-2", "99", at(1)), ("m-3", "in_use", at(2)), (None, "IDLE", at(1))],
        "machine_id string, status string, last_updated timestamp_ntz",
    )
    assert ordered(stg_machine_status(raw), "machine_id", "status") == [("M-1", "INPROGRESS"), ("M-3", "IN_USE")]


def test_newest_order_row_wins_and_undated_orders_stay(spark):
    raw = spark.createDataFrame(
        [
            ("A", "M-1", "p", 1, "OPEN", None), (" A ", "M-1", "p", 2, "OPEN", at(1)), ("A", " m 2", "p", 3, "DONE", at(2)),
            ("B", "M-2", "q", 1, "OPEN", None), ("B", "M-1", "q", 1, "OPEN", None),
            ("", "M-1", "p", 1, "OPEN", at(1)), ("C", "  ", "p", 1, "OPEN", at(1)),
        ],
        "order_id string, machine_id string, product_name string, target_quantity int, order_status string, created_at timestamp_ntz",
    )
    assert ordered(stg_work_orders(raw), "order_id", "machine_id", "order_status") == [("A", "m 2", "DONE"), ("B", "M-1", "OPEN")]


def test_keys_and_numbers(spark):
    ids = ["M-00-1", "LINE2-M7", "PRESS", "M-" + "9" * 39]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = rows(df, machine_key(F.col("id")), machine_num(F.col("id")).cast("string"))
    assert got == [("M001", "0"), ("LINE2M7", "2"), ("PRESS", None), ("M" + "9" * 39, None)]


@pytest.mark.parametrize(
    "temperature, vibration, limit, flag",
    [(90.0, 2.0, 90.0, 0), (90.01, 0.0, 90.0, 1), (None, 2.01, 90.0, 1), (None, None, 90.0, 0), (85.0, 0.0, 85.0, 0), (85.01, None, 85.0, 1)],
)
def test_anomaly_edges(spark, temperature, vibration, limit, flag):
    df = spark.createDataFrame([(temperature, vibration)], "t double, v double")
    assert rows(df, rules.anomaly_expr(F.col("t"), F.col("v"), limit)) == [(flag,)]


def test_threshold_floor(spark):
    df = spark.createDataFrame([(None,), (80.0,), (92.0,)], "p double")
    assert rows(df, rules.threshold_expr(F.col("p"), 85.0)) == [(None,), (85.0,), (92.0,)]


@pytest.mark.parametrize(
    "breaches, changes, rate, score",
    [
        ((0, 0), (1.5, 0.0), 0.0, 15), ((0, 0), (1.49, 0.25), 0.0, 10), ((0, 0), (0.0, 0.0), 0.10, 8),
        ((0, 0), (0.0, 0.0), 0.1999, 8), ((0, 0), (0.0, 0.0), 0.20, 15), ((1, 1), (2.0, 1.0), 1.0, 100), ((1, 0), (None, None), None, 35),
    ],
)
def test_score_edges(spark, breaches, changes, rate, score):
    df = spark.createDataFrame([(*breaches, *changes, rate)], "tb int, vb int, tc double, vc double, r double")
    assert rows(df, rules.risk_score_expr(*[F.col(c) for c in df.columns])) == [(score,)]


def test_level_edges(spark):
    df = spark.createDataFrame([(39,), (40,), (69,), (70,)], "s int")
    assert [r[0] for r in rows(df, rules.risk_level_expr(F.col("s")))] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_not_a_number_becomes_null(spark):
    assert rows(sensor(spark, [(0, "A", float("nan"), 1.0)]), rules.not_nan(F.col("temperature"))) == [(None,)]


def test_two_decimals_follow_the_binary_value(spark):
    # 0.125 is exact and goes up; 79.725 and 1.005 are a little less in binary; 1.255 too.
    df = spark.createDataFrame([(0.125,), (79.725,), (1.005,), (2.5,), (-0.125,), (100.0,)], "x double")
    assert [r[0] for r in rows(df, two_decimals(F.col("x")))] == ["0.13", "79.72", "1.00", "2.50", "-0.13", "100.00"]
