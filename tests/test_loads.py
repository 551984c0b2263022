from __future__ import annotations

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows, sensor, status
from millpulse import schemas
from millpulse.operators import maintenance
from millpulse.plans.exploration import run_exploration
from millpulse.plans.ingest import IngestPaths, run_ingest
from millpulse.plans.marts import build_models, write_marts
from millpulse.sources import incremental, raw, split_csv, storage, tables


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_sensor_files_are_read_tolerantly(spark, work):
    good = {"timestamp": "2024-03-01T07:00:00.250+07:00", "machine_id": "M-1", "temperature": 80.5, "vibration": "1.5"}
    bad = {"timestamp": "bad", "machine_id": "M-2", "temperature": "x", "vibration": "NaN", "extra": 1}
    error = {"raw_message": "{", "parse_error": "invalid_json", "ingested_at": "2024-03-01"}
    put(f"{work}/year=2024/month=03/day=01/a.json", json.dumps([good, bad, error]))
    put(f"{work}/year=2024/month=03/day=02/b.json", json.dumps(good) + "\nnot json\n")
    put(f"{work}/year=2024/month=03/day=02/c.csv", "ignored")
    put(f"{work}/other/d.json", json.dumps(good))
    loaded = raw.load_sensor_raw(spark, work)
    assert loaded.schema == schemas.SENSOR_RAW
    first = (datetime(2024, 3, 1, 0, 0, 0, 250000), "M-1", 80.5, 1.5)
    assert ordered(loaded) == sorted([first, (None, "M-2", None, None), (None, None, None, None), first], key=repr)
    assert rows(raw.load_sensor_raw(spark, work, landed_since=date(2024, 3, 2))) == [first]
    assert loaded.count() == 4 and loaded.filter("machine_id = 'M-1'").count() == 2


def test_csv_exports_are_read_by_position(spark, work):
    put(
        f"{work}/work_orders_1.csv",
        'id,any,names,here,a,b\nWO-1,M-1,"Widget, ""big""",12.7,OPEN,2024-03-01 00:00:00\nWO-2,M-2,W,many,OPEN,bad\nWO-3,short\n'
        'WO-4,M-4,"two\nlines",1,OPEN,,one,too,many\n',
    )
    put(f"{work}/machine_status_1.csv", "a,b,c\nM-1,IDLE,2024-03-01T00:00:00Z\n")
    assert rows(raw.load_work_orders_raw(spark, work)) == [
        ("WO-1", "M-1", 'Widget, "big"', Decimal(13), "OPEN", at(0)), ("WO-2", "M-2", "W", None, "OPEN", None),
        ("WO-3", "short", None, None, None, None), ("WO-4", "M-4", "two\nlines", Decimal(1), "OPEN", None),
    ]
    assert rows(raw.load_machine_status_raw(spark, work)) == [("M-1", "IDLE", at(0))]
    assert raw.load_work_orders_raw(spark, work).count() == 4
    assert rows(raw.load_work_orders_raw(spark, work), "created_at") == [(at(0),), (None,), (None,), (None,)]


QUOTED = ["plain", 'a "quoted" word', "two\nlines", "three\r\nlines\n", "comma, and \"\n\" break", "", '"', '\n"\n', "x" * 300]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_file_is_read_by_many_tasks(spark, work, ending):
    schema = schemas.as_text(schemas.MACHINE_STATUS_RAW)

    def cell(text):
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') or not text else text

    lines = [f'id,"sta{ending}tus",x'] + [",".join((f"M-{n}", cell(QUOTED[n * 7 % len(QUOTED)] if n > 300 else f"s{n}"), f"t{n}")) for n in range(1_500)]
    lines[40:40] = ["", "M,short", "M,a,b,surplus"]
    put(f"{work}/one/machine_status_1.csv", ending.join(lines) + (ending if ending == "\n" else ""))
    put(f"{work}/one/machine_status_2.csv", "")
    put(f"{work}/one/machine_status_3.csv", f"id,b,c{ending}")
    files = f"{work}/one/machine_status_*.csv"
    want = ordered(spark.read.schema(schema).options(**raw.CSV_OPTIONS).csv(files))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert split_csv._lines(spark, files).rdd.getNumPartitions() > 10
        got = split_csv.read_split_csv(spark, files, schema, raw.CSV_OPTIONS)
        assert len(want) == 1_502 and ordered(got) == want
        # Quotes inside a cell without quotes around it: that file is read in one task, the others are not.
        put(f"{work}/one/machine_status_4.csv", 'id,b,c\nM,5" pipe,x\nM,6" pipe,y\nM,"q",z\n')
        want = ordered(spark.read.schema(schema).options(**raw.CSV_OPTIONS).csv(files))
        assert ordered(split_csv.read_split_csv(spark, files, schema, raw.CSV_OPTIONS)) == want and len(want) == 1_505
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("bits", [0, 4])
def test_lines_of_a_large_file_are_not_shuffled_to_place_them(spark, work, monkeypatch, bits):
    monkeypatch.setattr(split_csv, "STRETCH_BITS", bits, raising=False)
    schema = schemas.as_text(schemas.MACHINE_STATUS_RAW)
    cell = lambda text: '"' + text.replace('"', '""') + '"'
    lines = ['id,"sta\ntus",x'] + [f"M-{n},{cell(QUOTED[n * 7 % len(QUOTED)]) if n % 40 < 20 else 's'},t{n}" for n in range(400)]
    put(f"{work}/one/machine_status_1.csv", "\n".join(lines) + "\n")
    put(f"{work}/one/machine_status_2.csv", "id,b,c\n" + "M,a,b\n" * 50 + 'M,"opened\n' + "x\n" * 1_500 + 'closed",z\nM,c,d\n')
    files = f"{work}/one/machine_status_*.csv"
    want = ordered(spark.read.schema(schema).options(**raw.CSV_OPTIONS).csv(files))
    settings = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert "SortMergeJoin" not in split_csv.csv_records(spark, files)._jdf.queryExecution().executedPlan().toString()
        assert ordered(split_csv.read_split_csv(spark, files, schema, raw.CSV_OPTIONS, trust_quotes=True)) == want
        assert ordered(split_csv.read_split_csv(spark, files, schema, raw.CSV_OPTIONS)) == want
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_loads_refuse_a_session_in_another_zone(spark, work):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        with pytest.raises(ValueError, match="UTC"):
            raw.load_machine_status_raw(spark, work)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_each_file_is_loaded_once_and_rejects_are_counted(spark, work):
    def load():
        incremental.incremental_load(
            spark, f"{work}/in/{raw.LANDED_SENSOR_FILES}", schemas.SENSOR_RAW, f"{work}/raw", f"{work}/checkpoint", max_files=1
        )
        return sorted(r[0] for r in rows(incremental.read_loaded(spark, f"{work}/raw", schemas.SENSOR_RAW), "machine_id"))

    put(f"{work}/in/year=2024/month=03/day=01/a.json", '{"machine_id": "A"}\n{broken\n')
    assert load() == ["A"]
    put(f"{work}/in/year=2024/month=03/day=01/b.json", '{"machine_id": "B"}\n')
    assert load() == ["A", "B"] and load() == ["A", "B"]
    assert rows(incremental.read_rejected(spark, f"{work}/raw", schemas.SENSOR_RAW), "rejected_text") == [("{broken",)]


def ledger(spark, target):
    return sorted((os.path.basename(r[0]), *r[1:]) for r in rows(incremental.read_ledger(spark, target), "source_file", "rows_loaded", "rows_rejected", "first_error"))


def test_the_ledger_keeps_what_became_of_each_file_over_cycles(spark, work):
    def load(fmt="json", name="sensor", schema=schemas.SENSOR_RAW, files=raw.LANDED_SENSOR_FILES, **options):
        incremental.incremental_load(spark, f"{work}/in/{files}", schema, f"{work}/{name}", f"{work}/{name}-checkpoint", fmt, **options)
        return ledger(spark, f"{work}/{name}")

    day = f"{work}/in/year=2024/month=03/day=01"
    put(f"{day}/a.json", '{"machine_id": "A"}\n{broken\n{also broken\n{"machine_id": "B"}\n')
    put(f"{day}/b.json", '{"machine_id": "C"}\n')
    first = [("a.json", 2, 2, "{broken"), ("b.json", 1, 0, None)]
    assert load() == first
    put(f"{day}/c.json", "x" * 500 + "\n")
    assert load() == [*first, ("c.json", 0, 1, "x" * incremental.ERROR_CHARS)] == load()
    put(f"{work}/in/machine_status_1.csv", 'a,b,c\nM-1,IDLE,2024-03-01T00:00:00Z\nM-2,short\nM-3,"two\nlines",,surplus\nM-4,IDLE,bad time\n')
    csv = {"fmt": "csv", "schema": schemas.MACHINE_STATUS_RAW, "files": "machine_status_*.csv"}
    assert load(name="tolerant", **csv) == [("machine_status_1.csv", 4, 0, None)]
    assert load(name="strict", reject_ragged=True, **csv) == [("machine_status_1.csv", 2, 2, "M-2,short")]
    assert sorted(rows(incremental.read_loaded(spark, f"{work}/strict", schemas.MACHINE_STATUS_RAW), "machine_id")) == [("M-1",), ("M-4",)]


def test_a_load_batch_that_fails_before_its_commit_counts_once(spark, work, monkeypatch):
    put(f"{work}/in/year=2024/month=03/day=01/a.json", '{"machine_id": "A"}\n{broken\n')

    def load():
        incremental.incremental_load(spark, f"{work}/in/{raw.LANDED_SENSOR_FILES}", schemas.SENSOR_RAW, f"{work}/raw", f"{work}/checkpoint")

    with monkeypatch.context() as broken:
        broken.setattr(storage, "write_json", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            load()
    assert incremental.read_loaded(spark, f"{work}/raw", schemas.SENSOR_RAW).count() == 0
    load()
    assert incremental.read_loaded(spark, f"{work}/raw", schemas.SENSOR_RAW).count() == 1 and ledger(spark, f"{work}/raw") == [("a.json", 1, 1, "{broken")]


def plant(spark):
    orders = spark.createDataFrame(
        [("WO-1", "M-001", "Widget, A", 5000, "OPEN", at(0)), ("WO-2", "M-002", "Widget-B", 2500, "IN_PROGRESS", at(1))],
        schemas.WORK_ORDERS_SOURCE,
    )
    return {"work_orders": orders, "machine_status": spark.createDataFrame([("M-001", "RUNNING", at(2))], schemas.MACHINE_STATUS_SOURCE)}


def test_load_cycle_repeats_plant_tables_but_not_sensor_files(spark, work):
    put(
        f"{work}/landed/year=2024/month=03/day=01/a.json",
        json.dumps([{"timestamp": "2024-03-01T00:00:00Z", "machine_id": "M-001", "temperature": 91, "vibration": 1}]),
    )
    paths = IngestPaths(f"{work}/landed", f"{work}/exports", f"{work}/raw", f"{work}/checkpoints")
    loaded = run_ingest(spark, plant(spark), paths, "20240301T00")
    assert {name: df.count() for name, df in loaded.items()} == {"sensor_data_raw": 1, "machine_status_raw": 1, "work_orders_raw": 2}
    assert ordered(loaded["work_orders_raw"], "order_id", "product_name", "target_quantity") == [
        ("WO-1", "Widget, A", Decimal(5000)), ("WO-2", "Widget-B", Decimal(2500)),
    ]
    loaded = run_ingest(spark, plant(spark), paths, "20240301T01")
    assert {name: df.count() for name, df in loaded.items()} == {"sensor_data_raw": 1, "machine_status_raw": 2, "work_orders_raw": 4}

    # The history is repeated, the models are not.
    models = build_models(loaded)
    assert models["stg_work_orders"].count() == 2 and models["work_orders_status"].count() == 2
    tables.register_models(models)
    assert spark.sql("select current_status, anomaly_events from machine_health_hourly").first() == ("RUNNING", 1)
    stored = write_marts(loaded, f"{work}/marts")
    assert rows(stored["machine_risk_hourly"], "machine_id", "machine_risk_score") == [("M-001", 15)]
    for name, df in stored.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, models[name].select(df.columns).collect()))


def test_exploration_run_writes_three_tables(spark, work):
    readings = sensor(spark, [(60 * h, m, 80.0 + h, 1.0) for m in "AB" for h in range(8)]).withColumnRenamed("event_ts", "timestamp")
    result = run_exploration(readings, at(hours=12), f"{work}/tables", f"{work}/out")
    assert result["summary"].count() == 1 and result["ranking"].count() == 2 and result["breaches"].count() == 2
    for name in ("machine_baseline_summary", "sustained_temp_breach_events", "machine_risk_ranking"):
        written = spark.read.option("header", True).csv(f"{work}/out/{name}.csv")
        assert written.count() == 2 and "machine_id" in written.columns


def test_created_tables_are_empty_and_stay(spark, work):
    tables.create_tables(spark, work)
    for name, schema in schemas.RAW_TABLES.items():
        df = spark.read.parquet(f"{work}/{name}")
        assert df.isEmpty() and df.columns == schema.fieldNames()
    spark.createDataFrame([("M-1", "IDLE", at(0))], schemas.MACHINE_STATUS_RAW).write.mode("append").parquet(f"{work}/machine_status_raw")
    tables.create_tables(spark, work)
    assert spark.read.parquet(f"{work}/machine_status_raw").count() == 1


def test_missing_times_become_now(spark):
    orders = spark.createDataFrame([("WO-1", None), ("WO-2", at(0))], "order_id string, created_at timestamp")
    filled = tables.with_default_now(orders, "work_orders")
    assert filled.filter("created_at is null").isEmpty() and filled.filter(F.col("created_at") == F.lit(at(0))).count() == 1


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], "id string, n int, s string")
    updates = spark.createDataFrame([("B", 3, None), ("C", 4, "z")], "id string, n int, s string")
    assert ordered(maintenance.upsert_by_key(target, updates, ["id"])) == [("A", 1, "x"), ("B", 3, None), ("C", 4, "z")]


def test_upsert_refuses_a_repeated_key(spark):
    target = spark.createDataFrame([("A", 1)], "id string, n int")
    updates = spark.createDataFrame([("B", 1), ("B", 1)], "id string, n int")
    with pytest.raises(Exception, match="same key more than once: B"):
        maintenance.upsert_by_key(target, updates, ["id"]).collect()


def test_counts_freshness_and_previews(spark):
    history = status(spark, [("A", "IDLE", 1), ("B", "IDLE", 3), ("C", "IDLE", None)])
    empty = history.limit(0)
    assert rows(maintenance.row_counts({"a": history, "b": empty})) == [("a", 3), ("b", 0)]
    assert rows(maintenance.freshness({"a": (history, "status_ts"), "b": (empty, "status_ts")})) == [("a", at(3)), ("b", None)]
    assert rows(maintenance.latest_rows(history, "status_ts", 2), "machine_id") == [("C",), ("B",)]
