"""Tables kept by streams and upserts: the same rows however the input is cut, whole batches only, few files touched."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows, sensor
from millpulse.operators import dashboard, health as hl, maintenance, sketches
from millpulse.sources import keyed, storage
from millpulse.streaming import admission, kept
from millpulse.streaming.buckets import BucketStore

MESSAGE = "timestamp string, machine_id string, temperature double, vibration double, arrival long, received timestamp_ntz"


def messages(spark, data):
    """(arrival, machine, temperature, minutes) rows."""
    return spark.createDataFrame([(f"t{n}", m, float(t), 1.0, n, at(minute)) for n, m, t, minute in data], MESSAGE)


def cuts(data, seed):
    """The rows in runs of random lengths, some of them empty."""
    rng, parts, left = random.Random(seed), [], list(data)
    while left:
        n = rng.randrange(0, 1 + len(left))
        parts.append(left[:n])
        left = left[n:]
    return parts


def feed(keep, frames, retry=None):
    for batch_id, frame in enumerate(frames):
        for _ in range(2 if batch_id == retry else 1):
            keep(frame, batch_id)


@pytest.mark.parametrize("seed", [0, 1])
def test_recent_messages_do_not_depend_on_batches(spark, work, seed):
    rng = random.Random(7)
    data = [(rng.randrange(12), f"M-{rng.randrange(5)}", rng.randrange(3), 0) for _ in range(40)]  # many arrive together
    parts = cuts(data, seed)
    feed(kept.recent_keeper(work, 9), [messages(spark, p) for p in parts], retry=len(parts) - 1)
    want = rows(dashboard.recent_messages(messages(spark, data), 9))
    assert rows(kept.read_recent(spark, work, 9)) == want and len(want) == 9
    assert kept.read_recent(spark, f"{work}/none").count() == 0


@pytest.mark.parametrize("seed", [2, 3])
def test_latest_per_machine_expires_the_same_way_for_any_batches(spark, work, seed):
    rng = random.Random(5)
    data = [(n // 2, f"M-{rng.randrange(8)}", rng.randrange(3), 10 * n) for n in range(60)] + [(99, "M-9", 1, 100), (-1, "M-9", 1, 0)]
    silent = timedelta(minutes=120)
    keep = kept.latest_keeper(work, F.col("received"), silent, buckets=3, every=2)
    parts = cuts(data, seed)
    feed(keep, [messages(spark, p) for p in parts], retry=1)
    newest = max(minute for *_, minute in data)
    best = {}
    for n, machine, temperature, minute in data:
        row = (-n, f"t{n}", temperature, -minute)
        best[machine] = min(best.get(machine, row), row)
    want = sorted((m, -n, float(t)) for m, (n, _, t, minute) in best.items() if -minute >= newest - 120)
    assert sorted(rows(kept.read_latest(spark, work), "machine_id", "arrival", "temperature")) == want
    assert "M-9" not in [m for m, *_ in want] and len(want) > 3
    keep(messages(spark, [(100, "M-X", 1, newest + 1_000)]), len(parts))  # everybody else has been silent since
    assert rows(kept.read_latest(spark, work), "machine_id") == [("M-X",)]


def test_closed_open_and_late_readings_are_all_readings(spark, work):
    rng = random.Random(1)
    data = [(rng.randrange(60 * 40), f"M-{rng.randrange(4)}", float(rng.randrange(70, 99)), 1.0) for _ in range(300)]
    parts = [sorted(data[:150])[:100], [], sorted(data[:150])[100:], data[150:]]
    delay = timedelta(hours=5)
    keep = kept.hours_keeper(work, delay)
    watermark, late, on_time = None, [], []
    for batch_id, part in enumerate(parts):
        for _ in range(2 if batch_id == 2 else 1):
            keep(sensor(spark, part), batch_id)
        for r in part:
            hour_end = 60 * (r[0] // 60 + 1)
            (late if watermark is not None and hour_end <= watermark else on_time).append(r)
        if part:
            watermark = max([w for w in (watermark, max(r[0] for r in part) - 300) if w is not None])
    found = kept.read_late(spark, work)
    assert ordered(found, "event_ts", "machine_id") == sorted([(at(m), i) for m, i, *_ in late], key=repr) and late
    assert {r.batch for r in found.collect()} == {3}
    want = hl.hourly_readings(sensor(spark, on_time))
    closed, still_open = kept.read_closed_hours(spark, work), kept.read_open_hours(spark, work)
    columns = ("hour_ts", "machine_id", "avg_temperature", "anomaly_events", "total_events")
    assert ordered(closed.unionByName(still_open.select(closed.columns)), *columns) == ordered(want, *columns)
    assert all(r.hour_ts + timedelta(hours=1) <= at(watermark) for r in closed.collect())
    assert all(r.hour_ts + timedelta(hours=1) > at(watermark) for r in still_open.collect())
    total = sum(r.total_events for r in closed.collect()) + sum(r.total_events for r in still_open.collect()) + found.count()
    assert total == len(data)


TICKS = "n long, seen timestamp_ntz"


def ticks(spark, data):
    return spark.createDataFrame([(n, at(minute)) for n, minute in data], TICKS).repartition(3)


def test_batches_are_flushed_by_size_or_age_and_never_empty(spark, work):
    admit = admission.admit(work, TICKS, "seen", ["n"], max_records=10, max_seconds=600)
    arrivals = [
        [(n, 0) for n in range(4)],  # wait
        [],  # nothing to flush
        [(n, 5) for n in range(4, 27)],  # two full batches, seven wait
        [(27, 14)],  # the oldest has waited nine minutes
        [(28, 15)],  # ten minutes: flushed by age
        [],
        [(n, 40) for n in range(29, 39)],  # a full batch and nothing left
        [(39, 41)],
    ]
    feed(admit, [ticks(spark, a) for a in arrivals], retry=4)
    found = admission.read_flushed(spark, work, TICKS).groupBy("flush", "reason").agg(F.count("n").alias("k"), F.min("n").alias("a"), F.max("n").alias("b"))
    assert sorted(rows(found)) == [(0, "records", 10, 0, 9), (1, "records", 10, 10, 19), (2, "age", 9, 20, 28), (3, "records", 10, 29, 38)]
    assert rows(admission.read_waiting(spark, work, TICKS), "n") == [(39,)]


def test_positions_follow_one_order_over_all_tasks(spark):
    rng = random.Random(4)
    data = [(rng.randrange(50), rng.randrange(5)) for _ in range(500)]
    numbered, n = admission.in_one_order(ticks(spark, data), ["seen"])
    got = [tuple(r) for r in numbered.orderBy("position").collect()]
    assert n == 500 and [p for *_, p in got] == list(range(500))
    assert [(s, k) for k, s, _ in got] == sorted((at(m), k) for k, m in data)
    numbered.unpersist()
    assert admission.in_one_order(ticks(spark, []), ["n"])[1] == 0


KEYED = "id long, part string, value int"


def test_upserts_rewrite_touched_buckets_only(spark, work):
    def frame(data):
        return spark.createDataFrame(data, KEYED)

    first = [(n, "a", n) for n in range(60)]
    keyed.upsert_table(work, frame(first), ["id", "part"], buckets=8)
    before = {f: None for f in keyed.read_table(spark, work).inputFiles()}
    second = [(3, "a", -3), (3, "b", 1), (700, "a", 7)]
    touched = keyed.upsert_table(work, frame(second), ["id", "part"])
    after = keyed.read_table(spark, work)
    want = maintenance.upsert_by_key(frame(first), frame(second), ["id", "part"])
    assert ordered(after, "id", "part", "value") == ordered(want, "id", "part", "value")
    kept_files = {f for f in after.inputFiles() if f in before}
    bucket = lambda f: int(f.split("/bucket=")[1].split("/")[0])
    assert 0 < len(touched) < 8 and kept_files == {f for f in before if bucket(f) not in touched}
    state = (storage.children(spark, f"{work}/rows"), ordered(after))
    for bad in ([(1, "a", 5), (1, "a", 5)], [(None, "a", 1)]):
        with pytest.raises(ValueError, match="NULL or occurs more than once"):
            keyed.upsert_table(work, frame(bad), ["id", "part"])
    assert (storage.children(spark, f"{work}/rows"), ordered(keyed.read_table(spark, work))) == state
    assert keyed.upsert_table(work, frame([]), ["id", "part"]) == [] and ordered(keyed.read_table(spark, work)) == state[1]


def test_a_batch_that_fails_before_its_manifest_does_not_show(spark, work, monkeypatch):
    keep = kept.recent_keeper(work, 5)
    keep(messages(spark, [(1, "A", 1, 0)]), 0)
    with monkeypatch.context() as broken:
        broken.setattr(storage, "write_json", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keep(messages(spark, [(2, "B", 1, 0)]), 1)
    assert rows(kept.read_recent(spark, work, 5), "machine_id") == [("A",)]
    keep(messages(spark, [(2, "B", 1, 0)]), 1)
    assert rows(kept.read_recent(spark, work, 5), "machine_id") == [("B",), ("A",)]
    assert BucketStore(spark, work, {}).manifests == [0, 1]


def test_stored_sketches_of_loads_add_up(spark):
    rng = random.Random(9)
    loads = [[(rng.randrange(60 * 72), f"M-{n % 2}", rng.gauss(80, 5), None) for n in range(3_000)] for _ in range(2)]
    stored = [sketches.machine_day_sketches(sensor(spark, load)) for load in loads]
    found = {r.machine_id: r for r in sketches.merged_quantiles(stored[0].unionByName(stored[1]), "machine_id").collect()}
    for machine in ("M-0", "M-1"):
        values = sorted(t for load in loads for _, i, t, _ in load if i == machine)
        rank = sum(v <= found[machine].temperature_quantile for v in values) / len(values)
        assert found[machine].temperature_n == len(values) and abs(rank - 0.95) <= 3 * sketches.rank_error()
        assert found[machine].vibration_n == 0 and found[machine].vibration_quantile is None
    many = [[(0, f"M-{n}", 1.0, 1.0) for n in range(lo, lo + 2_000)] for lo in (0, 1_000)]
    machines = [sketches.day_machine_sketches(sensor(spark, load)) for load in many]
    estimate = sketches.merged_machines(machines[0].unionByName(machines[1])).first().machines
    assert abs(estimate / 3_000 - 1) <= 4 * sketches.distinct_error()
