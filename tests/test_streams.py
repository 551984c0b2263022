from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows, sensor, status
from millpulse.operators import health as hl
from millpulse.sources import storage
from millpulse.streaming import live, risk, state


def random_readings(seed, n=300):
    rng = random.Random(seed)
    return [(rng.randrange(60 * 24 * 2), f"M-{rng.randrange(6)}", rng.uniform(75, 95), rng.uniform(0, 3)) for _ in range(n)]


def put_batches(spark, folder, readings, parts):
    for part in range(parts):
        sensor(spark, readings[part::parts]).coalesce(1).write.mode("append").parquet(folder)


def reading_stream(spark, folder):
    return spark.readStream.schema(sensor(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_closed_hours_equal_the_batch_result(spark, work):
    readings = random_readings(0)
    put_batches(spark, f"{work}/in", readings, 1)
    hours = live.stream_health_hourly(reading_stream(spark, f"{work}/in"), "3 hours")
    query = hours.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start(f"{work}/out")
    query.awaitTermination()
    latest = max(at(m) for m, *_ in readings)
    closed = hl.hourly_readings(sensor(spark, readings)).filter(
        F.col("hour_ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(latest).cast("timestamp_ntz") - F.expr("INTERVAL 3 HOURS")
    )
    emitted = spark.read.schema(hours.schema).parquet(f"{work}/out")
    exact = ("hour_ts", "machine_id", "anomaly_events", "total_events")
    assert closed.count() > 0 and ordered(emitted, *exact) == ordered(closed, *exact)


def test_late_rows_of_closed_hours_are_dropped(spark, work):
    sensor(spark, [(0, "A", 80.0, 1.0), (600, "A", 80.0, 1.0)]).coalesce(1).write.parquet(f"{work}/in")

    def run():
        hours = live.stream_health_hourly(reading_stream(spark, f"{work}/in"), "1 hour")
        hours.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start(f"{work}/out").awaitTermination()
        return ordered(spark.read.schema(hours.schema).parquet(f"{work}/out"), "hour_ts", "total_events")

    assert run() == [(at(0), 1)]
    sensor(spark, [(1, "A", 80.0, 1.0), (1200, "A", 80.0, 1.0)]).coalesce(1).write.mode("append").parquet(f"{work}/in")
    assert run() == [(at(0), 1), (at(600), 1)]


@pytest.mark.parametrize("every", [1, 50])
def test_refreshed_marts_equal_the_batch_result(spark, work, every):
    readings = random_readings(1)
    put_batches(spark, f"{work}/in", readings, 4)
    history = status(spark, [("M-1", "RUNNING", 0), ("M2", "IDLE", 0)])
    refresh = risk.mart_refresher(work, history, every, 4)
    batches = []

    def counted(batch, batch_id):
        batches.append(batch_id)
        refresh(batch, batch_id)
        if batch_id == 2:
            refresh(batch, batch_id)  # a retried batch changes nothing

    reading_stream(spark, f"{work}/in").writeStream.foreachBatch(counted).option("checkpointLocation", f"{work}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert len(batches) == 4
    batch = hl.machine_risk_hourly(hl.machine_health_hourly(sensor(spark, readings), history))

    def comparable(df):
        exact = df.select("hour_ts", "machine_id", "current_status", "total_events", "anomaly_events", "machine_risk_score", "machine_risk_level")
        return ordered(exact)

    got = risk.read_risk(spark, work)
    assert comparable(got) == comparable(batch)
    assert comparable(risk.read_risk(spark, work, list(range(4)))) == comparable(batch)
    means = [sorted(r[0] for r in rows(df, "rolling_mean_temp_3h")) for df in (got, batch)]
    assert means[0] == pytest.approx(means[1])


def test_a_status_change_is_seen_without_new_readings(spark, work):
    calm = sensor(spark, [(0, "M-1", 80.0, 1.0), (60, "M-1", 81.0, 1.0), (0, "M-2", 80.0, 1.0)])
    risk.mart_refresher(work, status(spark, [("M-1", "IDLE", 0)]), 2, 4)(calm, 0)
    changed = status(spark, [("M-1", "IDLE", 0), ("M-1", "RUNNING", 5), ("M-2", "IDLE", 5)])
    risk.mart_refresher(work, lambda: changed, 2, 4)(sensor(spark, [(60, "M-3", 80.0, 1.0)]), 1)
    assert ordered(risk.read_risk(spark, work), "machine_id", "current_status") == [
        ("M-1", "RUNNING"), ("M-1", "RUNNING"), ("M-2", "IDLE"), ("M-3", "UNKNOWN"),
    ]


EXACT = ("hour_ts", "machine_id", "current_status", "total_events", "machine_risk_score", "machine_risk_level", "temp_rate_of_change")


def run_batches(spark, work, history, batches, check=None):
    """Feed the batches one by one; the risk equals the batch result after each."""
    refresh, seen = risk.mart_refresher(work, history, 2, 4), []
    for batch_id, readings in enumerate(batches):
        refresh(sensor(spark, readings), batch_id)
        seen += readings
        want = hl.machine_risk_hourly(hl.machine_health_hourly(sensor(spark, seen), history))
        assert ordered(risk.read_risk(spark, work), *EXACT) == ordered(want, *EXACT), batch_id
        assert rows(risk.read_risk(spark, work).where("machine_risk_score < 0 or machine_risk_score > 100")) == []


def test_risk_holds_after_every_batch_with_late_readings_and_machines_that_match_twice(spark, work):
    # Whole numbers, so that sums do not depend on the order of adding.
    def part(hours, machines, seed):
        rng = random.Random(seed)
        return [(60 * h + rng.randrange(60), m, float(rng.randrange(75, 99)), float(rng.randrange(4))) for h in hours for m in machines for _ in range(2)]

    history = status(spark, [("M-1", "RUNNING", 0), ("X-1", "IDLE", 0), ("Y-1", "IDLE", 0), ("M2", "IDLE", 0)])
    run_batches(spark, work, history, [
        part(range(5), ["M-1", "M-2", "N"], 0), part(range(4, 9), ["M-1", "N"], 1),
        part([2, 20], ["M-2"], 2) + [(60 * 3, "M-1", None, 1.0)], part([21], ["M-1", "M-2", "P"], 3), [],
    ])


def test_a_cut_tail_is_rebuilt_when_the_percentile_sinks_below_it(spark, work, monkeypatch):
    monkeypatch.setattr(risk, "CUT_FROM", 10)
    hot = [(60 * h, "A", 70.0 + h, 1.0) for h in range(40)]
    cold = [(60 * (40 + h), "A", 20.0 - h / 8, 1.0) for h in range(100)]  # most averages are now far below the old tail
    later = [(60 * (200 + h), "A", 60.0 + h, 1.0) for h in range(3)]
    opened = []
    real = risk._with_whole_tails
    monkeypatch.setattr(risk, "_with_whole_tails", lambda rows_of, features: opened.append(1) or real(rows_of, features))
    history = status(spark, [("A", "IDLE", 0)])
    run_batches(spark, work, history, [hot])
    machine = risk.BucketStore(spark, work, risk.TABLES).read("machines").first()
    assert not opened and machine.temperature_cut > 70 and sum(e.n for e in machine.temperature_tail) == 40 > len(machine.temperature_tail)
    run_batches(spark, f"{work}/all", history, [hot, cold, later])
    assert len(opened) == 1


def test_a_batch_opens_only_the_buckets_it_touches(spark, work):
    history = status(spark, [("M-1", "RUNNING", 0)])
    refresh = risk.mart_refresher(work, history, 3, 8)
    refresh(sensor(spark, [(m, f"M-{i}", 80.0, 1.0) for i in range(40) for m in (0, 60)]), 0)
    store = risk.BucketStore(spark, work, risk.TABLES)
    assert len(store.folders["features"]) > 4
    before = {table: {b: list(ns) for b, ns in buckets.items()} for table, buckets in store.folders.items()}
    one = sensor(spark, [(120, "M-7", 80.0, 1.0)])
    touched = store.touched(one, "machine_id")
    assert len(touched) == 1
    for table in risk.TABLES:
        files = store.read(table, touched).inputFiles()
        assert files and all(f"/bucket={touched[0]}/" in f for f in files)
    refresh(one, 1)
    after = risk.BucketStore(spark, work, risk.TABLES).folders
    changed = {(table, int(b)) for table in after for b in after[table] if after[table][b] != before[table][b]}
    assert changed == {("features", touched[0]), ("machines", touched[0])}
    with pytest.raises(ValueError, match="another stream"):
        refresh(one, 0)


def test_merged_buckets_keep_few_folders_and_old_ones_go(spark, work):
    refresh = risk.mart_refresher(work, status(spark, [("A", "IDLE", 0)]), 2, 1)
    for batch_id in range(6):
        refresh(sensor(spark, [(60 * batch_id, "A", 80.0 + batch_id, 1.0)]), batch_id)
    store = risk.BucketStore(spark, work, risk.TABLES)
    assert all(len(ns) <= 2 for buckets in store.folders.values() for ns in buckets.values())
    stored = {f.split("/batch=")[1].split("/")[0] for f in spark.read.parquet(f"{work}/features").inputFiles()}
    assert len(stored) <= 4 and len(storage.children(spark, f"{work}/manifests")) == 2
    assert risk.read_risk(spark, work).count() == 6


def test_folders_read_do_not_grow_with_batches(spark, work):
    every = 3
    for batch_id in range(10):
        rows_of = spark.createDataFrame([("A", batch_id), (f"M{batch_id}", 0)], "machine_id string, n int")
        for _ in range(2 if batch_id in (2, 5) else 1):  # a retried last batch of a round writes the same snapshot
            live.write_version(f"{work}/v", every=every)(rows_of, batch_id)
        state_rows = state.read_state(spark, f"{work}/v", batch_id, every)
        folders = {f.rsplit("/", 2)[1] for f in state_rows.inputFiles()}
        assert len(folders) <= every + 1
        newest = {r.machine_id: r.n for r in live.read_versions(spark, f"{work}/v", every=every).collect()}
        assert newest == {"A": batch_id} | {f"M{i}": 0 for i in range(batch_id + 1)}
