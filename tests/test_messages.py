from __future__ import annotations

import glob
import json
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import at, ordered, rows
from millpulse import fixtures
from millpulse.operators import dashboard
from millpulse.sources import landed_csv, storage
from millpulse.sources.landed_csv import load_landed_csv
from millpulse.sources.raw import load_sensor_raw
from millpulse.streaming import landing, live
from millpulse.streaming import messages as msg


def bodies(spark, texts):
    data = [(n, t if isinstance(t, bytes) else t.encode()) for n, t in enumerate(texts)]
    return spark.createDataFrame([(n, bytearray(b)) for n, b in data], "arrival long, body binary")


def test_malformed_messages_are_kept(spark):
    texts = ["{", "[1]", '"x"', "null", "", '{"machine_id":"M-1"}', b"A\x80", '{"a":1} tail', '{"a":1}]', '{"a":1},0', '{"a":1} {"b":2}', ' {"a":1} ']
    parsed = msg.parse_messages(bodies(spark, texts), F.lit(at(0)))
    got = {r.arrival: (r.parse_error, r.raw_message) for r in parsed.collect()}
    assert got == {
        0: ("invalid_json", "{"), 1: ("non_object_json", "[1]"), 2: ("non_object_json", '"x"'), 3: ("non_object_json", "null"),
        4: ("invalid_json", ""), 5: (None, None), 6: ("invalid_json", "A�"), 7: ("invalid_json", '{"a":1} tail'),
        8: ("invalid_json", '{"a":1}]'), 9: ("invalid_json", '{"a":1},0'), 10: ("invalid_json", '{"a":1} {"b":2}'), 11: (None, None),
    }
    stamps = {r.ingested_at is not None for r in parsed.collect() if r.parse_error}
    assert stamps == {True}


COERCIONS = [
    ("null", 0.0), ("12.5", 12.5), ('"12.5"', 12.5), ('" 12 "', 12.0), ('"1e3"', 1000.0), ('""', 0.0), ('"  "', 0.0),
    ("true", 1.0), ("false", 0.0), ('"0x1A"', 26.0), ('"0b11"', 3.0), ('"0o17"', 15.0), ('"-.5"', -0.5), ('"5."', 5.0),
    ("1e3", 1000.0), ("123456789012", 123456789012.0),
    ('"0x1234567890abcdef"', float(0x1234567890ABCDEF)), ("[5]", 5.0), ("[]", 0.0), ('["7"]', 7.0), ("[null]", 0.0),
    ('"\u00a03\u2003"', 3.0),
]


@pytest.mark.parametrize("field", ["temperature", "vibration"])
def test_accepted_numbers(spark, field):
    other = "vibration" if field == "temperature" else "temperature"
    texts = [f'{{"machine_id": " M-1 ", "{field}": {value}, "{other}": 1}}' for value, _ in COERCIONS]
    got = msg.validate_payload(msg.parse_messages(bodies(spark, texts))).orderBy("arrival").select("machine_id", field, "is_valid").collect()
    assert [tuple(r) for r in got] == [("M-1", number, True) for _, number in COERCIONS]


def test_infinity_is_accepted_but_stored_as_null(spark):
    texts = ['{"machine_id": "A", "temperature": "Infinity", "vibration": "-Infinity"}']
    assert rows(msg.validate_payload(msg.parse_messages(bodies(spark, texts))), "temperature", "vibration", "is_valid") == [(None, None, True)]


@pytest.mark.parametrize(
    "fields",
    [
        '"machine_id": "A", "vibration": 1', '"machine_id": "A", "temperature": "abc", "vibration": 1',
        '"machine_id": "A", "temperature": {}, "vibration": 1', '"machine_id": "A", "temperature": [1, 2], "vibration": 1',
        '"machine_id": "A", "temperature": "1d", "vibration": 1', '"machine_id": "A", "temperature": "NaN", "vibration": 1',
        '"machine_id": 5, "temperature": 1, "vibration": 1', '"machine_id": " \\t", "temperature": 1, "vibration": 1',
        '"temperature": 1, "vibration": 1', '"machine_id": "A", "temperature": "- 5", "vibration": 1',
        '"machine_id": "\\u00a0", "temperature": 1, "vibration": 1', '"machine_id": "A", "temperature": [true], "vibration": 1',
    ],
)
def test_rejected_payloads(spark, fields):
    accepted, rejected = msg.split_valid(msg.validate_payload(msg.parse_messages(bodies(spark, ["{" + fields + "}"]))))
    assert accepted.isEmpty() and rejected.count() == 1


def test_timestamps_stay_verbatim_or_become_the_time_of_receipt(spark):
    given = ['"2024-03-01T07:00:00+07:00"', '"2024-03-01"', '"2024-13-01"', '"yesterday"', "5", "null"]
    texts = [f'{{"machine_id": "A", "temperature": 1, "vibration": 1, "timestamp": {g}}}' for g in given]
    got = [r[0] for r in rows(msg.validate_payload(msg.parse_messages(bodies(spark, texts)), F.lit(at(0))).orderBy("arrival"), "timestamp")]
    assert got == ["2024-03-01T07:00:00+07:00", "2024-03-01"] + ["2024-03-01T00:00:00.000Z"] * 4
    common = ["2024-01-01 10:00:00", "Jan 1, 2024 10:00", "2024-01-01T10:00:00+0700", "1/2/2024", "Jan 32, 2024"]
    texts = [f'{{"machine_id": "A", "temperature": 1, "vibration": 1, "timestamp": "{g}"}}' for g in common]
    got = [r[0] for r in rows(msg.validate_payload(msg.parse_messages(bodies(spark, texts)), F.lit(at(0))).orderBy("arrival"), "timestamp")]
    assert got == common[:4] + ["2024-03-01T00:00:00.000Z"]


def test_the_last_of_a_repeated_key_counts(spark):
    texts = ['{"machine_id": "A", "machine_id": "B", "temperature": 1, "vibration": 1}']
    assert rows(msg.validate_payload(msg.parse_messages(bodies(spark, texts))), "machine_id", "is_valid") == [("B", True)]


def test_landing_keeps_keys_beyond_the_four(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"machine_id": "A", "temperature": 1, "vibration": 2, "alarm": {"code": [7]}}'])
    land(spark, work, "json")
    lines = [json.loads(line) for f in glob.glob(f"{work}/out/*/*/*/*.txt") for line in open(f, encoding="utf-8")]
    assert lines == [{"machine_id": "A", "temperature": 1, "vibration": 2, "alarm": {"code": [7]}}]


def message_stream(spark, folder):
    return msg.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, folder)


def write_lines(folder, name, lines):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def land(spark, work, fmt, **options):
    query = landing.land_stream(
        msg.parse_messages(message_stream(spark, f"{work}/in")), f"{work}/out", f"{work}/checkpoint", fmt, available_now=True, **options
    )
    query.awaitTermination()


def test_json_landing_appends_once_and_loads(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"timestamp": "2024-03-01T00:00:00Z", "machine_id": "A", "temperature": 80.5, "vibration": 1}', "{"])
    land(spark, work, "json")
    write_lines(f"{work}/in", "b", ['{"timestamp": "2024-03-01T00:01:00Z", "machine_id": "B", "temperature": "81", "vibration": null}'])
    land(spark, work, "json")
    land(spark, work, "json")
    assert ordered(load_sensor_raw(spark, f"{work}/out")) == sorted(
        [(at(0), "A", 80.5, 1.0), (at(1), "B", 81.0, None), (None, None, None, None)], key=repr
    )
    now = datetime.now(timezone.utc)
    assert glob.glob(f"{work}/out/year={now:%Y}/month={now:%m}/day=*/*.txt")
    lines = [json.loads(line) for f in glob.glob(f"{work}/out/*/*/*/*.txt") for line in open(f, encoding="utf-8")]
    error = next(r for r in lines if "parse_error" in r)
    assert error.keys() == {"raw_message", "parse_error", "ingested_at"} and error["raw_message"] == "{"


def test_landing_any_keys(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"b": 1, "B": 2, "a": {"x": [1, 2]}, "day": "d"}', '{"c": null}', "5"])
    land(spark, work, "json", fields=None)
    lines = [json.loads(line) for f in glob.glob(f"{work}/out/*/*/*/*.txt") for line in open(f, encoding="utf-8")]
    got = sorted((r for r in lines if "parse_error" not in r), key=str)
    assert {"b": 1, "B": 2, "a": {"x": [1, 2]}, "day": "d"} in got and any("b" not in r for r in got) and len(lines) == 3


def test_csv_header_is_the_sorted_union_of_keys(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"b": 1.0, "a": " x,\\"y\\" "}', '{"c": true, "a": null}'])
    land(spark, work, "csv")
    files = [open(f, encoding="utf-8").read().splitlines() for f in glob.glob(f"{work}/out/year=*/*/*/*/*/*.csv")]
    assert {f[0] for f in files} == {"a,b,c"}
    assert sorted(line for f in files for line in f[1:]) == ['" x,""y"" ",1.0,', ",,True"]


def test_landing_checks_its_arguments(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ["{}"])
    for options in ({"fmt": "xml"}, {"fmt": "json", "flush_seconds": 0}):
        with pytest.raises(ValueError):
            landing.land_stream(msg.parse_messages(message_stream(spark, f"{work}/in")), f"{work}/out", f"{work}/c", **options)
    assert msg.batch_limits(500, 60) == {"minOffsetsPerTrigger": "500", "maxOffsetsPerTrigger": "500", "maxTriggerDelay": "60s"}


def test_latest_recent_and_display(spark):
    data = [(n, f"M-{n % 3}", f"t{n}", 89.0 + n, 0.125) for n in range(6)]
    payloads = spark.createDataFrame(data, "arrival long, machine_id string, timestamp string, temperature double, vibration double")
    latest = dashboard.latest_per_machine(payloads)
    assert ordered(latest, "machine_id", "timestamp") == [("M-0", "t3"), ("M-1", "t4"), ("M-2", "t5")]
    assert [r[0] for r in rows(dashboard.recent_messages(payloads, 2), "timestamp")] == ["t5", "t4"]
    assert rows(dashboard.dashboard_rows(latest), "machine_id", "temperature_class", "temperature_text", "vibration_text")[0] == ("M-0", "hot", "92.00", "0.13")


def test_counters_and_latest_over_several_batches(spark, work, tmp_path):
    (tmp_path / "in").mkdir()

    def body(machine, temperature):
        return f'{{"machine_id": "{machine}", "temperature": {temperature}, "vibration": 1, "timestamp": "2024-03-01"}}'

    def run():
        stream = message_stream(spark, f"{work}/in").withColumn("arrival", F.get_json_object("body", "$.temperature").cast("long"))
        validated = msg.validate_payload(msg.parse_messages(stream))
        accepted = msg.split_valid(validated)[0]
        for name, table in (("latest", live.stream_latest(accepted)), ("counts", live.stream_counts(validated))):
            live.start_versions(table, f"{work}/{name}", f"{work}/{name}-checkpoint", available_now=True).awaitTermination()
        return (
            ordered(live.read_versions(spark, f"{work}/latest"), "machine_id", "temperature"),
            rows(dashboard.message_counters(live.read_versions(spark, f"{work}/counts"), published)),
        )

    published = spark.range(2)  # a sink that has committed two messages so far
    write_lines(f"{work}/in", "a", [body("A", 1), body("B", 5), "{", body("", 9)])
    write_lines(f"{work}/in", "b", [body("A", 3)])
    assert run() == ([("A", 3.0), ("B", 5.0)], [(3, 2, 2, 2)])
    write_lines(f"{work}/in", "c", [body("A", 2), body("C", 1)])
    assert run() == ([("A", 3.0), ("B", 5.0), ("C", 1.0)], [(5, 2, 2, 3)])


def test_landed_csv_is_read_by_each_files_header(spark, work, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"b": "1", "a": "two\\nlines"}'])
    land(spark, work, "csv")
    write_lines(f"{work}/in", "b", ['{"a": "x", "c": "y"}'])
    land(spark, work, "csv")
    assert ordered(load_landed_csv(spark, f"{work}/out"), "a", "b", "c") == sorted([("two\nlines", "1", None), ("x", None, "y")], key=repr)


def test_a_large_csv_batch_is_landed_in_files_of_bounded_length(spark, work, monkeypatch):
    monkeypatch.setattr(landed_csv, "FILE_RECORDS", 30, raising=False)
    rows_in = spark.createDataFrame([(b'{"a": "%d\\n"}' % n,) for n in range(100)], "body binary").coalesce(1)
    landing.union_writer(f"{work}/out", "s")(landing.with_landing_day(msg.parse_messages(rows_in)), 0)
    assert len(glob.glob(f"{work}/out/year=*/month=*/day=*/header=*/batch=s-0/*.csv")) == 4
    assert ordered(load_landed_csv(spark, f"{work}/out"), "a") == sorted([(f"{n}\n",) for n in range(100)], key=repr)


@pytest.mark.parametrize("maker", ["event_files", "event_batches"])
def test_a_batch_of_events_is_one_file_that_many_tasks_read(spark, work, monkeypatch, maker):
    monkeypatch.setattr(fixtures, "ROW_GROUP_BYTES", {"parquet.block.size": "65536"}, raising=False)
    day = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 86).cast("timestamp_ntz")
    events = spark.range(30_000).select(
        F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") % 90).alias("user_id"), F.lit("view").alias("event_type"),
        F.rand(1).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    events.write.parquet(f"{work}/sf/events.parquet")
    getattr(fixtures, maker)(spark, f"{work}/sf", f"{work}/files")
    files = [pq.ParquetFile(path).metadata for path in glob.glob(f"{work}/files/*.parquet")]
    assert len(files) == {"event_files": 3, "event_batches": 5}[maker]
    assert sum(f.num_rows for f in files) == 30_000 and max(f.num_row_groups for f in files) > 1


def test_endless_keys_fail_loudly(spark, work, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MAX_COLUMNS", 3)
    (tmp_path / "in").mkdir()
    write_lines(f"{work}/in", "a", ['{"a": 1, "b": 1, "c": 1, "d": 1}'])
    with pytest.raises(Exception, match="more than 3 different keys"):
        land(spark, work, "csv")


def test_a_csv_batch_that_fails_half_way_lands_once(spark, work, monkeypatch):
    parsed = msg.parse_messages(spark.createDataFrame([(b'{"a": 1}',), (b'{"b": 2, "year": "y", "batch": "x"}',), (b"{",)], "body binary"))
    batch = landing.with_landing_day(parsed)
    writer = landing.union_writer(f"{work}/out", "s")
    real = storage.write_json

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(storage, "write_json", fail)
    with pytest.raises(OSError):
        writer(batch, 0)
    assert load_landed_csv(spark, f"{work}/out").count() == 0  # the rows are there, but do not count
    monkeypatch.setattr(storage, "write_json", real)
    for _ in range(2):  # retried, and repeated once more
        writer(batch, 0)
        assert ordered(load_landed_csv(spark, f"{work}/out"), "a", "b", "year", "batch", "raw_message") == sorted(
            [("1", None, None, None, None), (None, "2", "y", "x", None), (None, None, None, None, "{")], key=repr
        )
    # A first try on another day leaves a folder that the commit does not name.
    other = landing.with_landing_day(parsed, F.lit("2020-01-01").cast("timestamp"))
    monkeypatch.setattr(storage, "write_json", fail)
    with pytest.raises(OSError):
        writer(other, 1)
    monkeypatch.setattr(storage, "write_json", real)
    writer(batch, 1)
    landing.union_writer(f"{work}/out", "t")(batch, 0)  # another stream into the same folder
    assert load_landed_csv(spark, f"{work}/out").count() == 9
