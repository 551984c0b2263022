"""Archives: written, read back, resolved and written anew."""

import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millpulse.llm import warc

SCHEMA = "page_id long, url string, html string, row string, original string, payload int"


def pages(spark, folder, rows, parts=3):
    """Stored pages with columns whose names the operator uses itself."""
    spark.createDataFrame([(*r, "row", "original", 1) for r in rows], SCHEMA).repartition(parts).write.parquet(folder)
    return spark.read.parquet(folder)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    out, first = [], {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        html = html or ""
        size = len(html.encode())
        repeats = size >= min_bytes and html in first
        out.append((page_id, size, digest(html), "revisit" if repeats else "response", first[html] if repeats else None))
        first.setdefault(html, page_id)
    return Counter(out)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def archived(spark, frame, folder, **options):
    run = warc.write_archives(warc.as_records(frame), folder, **options)
    return run, warc.read_archives(spark, folder, run)


def rows_of(records):
    return Counter(tuple(r) for r in warc.resolve_revisits(records).select(COLUMNS).collect())


def odd_rows():
    rng = random.Random(0)
    texts = [f"<p>{rng.random()}</p>" for _ in range(60)]
    rows = [(i, f"http://a/{i}", rng.choice(texts)) for i in range(300)]
    rows += [(1_000 + i, "http://copy/", "<html>the same</html>") for i in range(150)]  # a third of all rows
    rows += [(2_000, None, None), (2_001, "", ""), (2_002, "http://x/\r\nWARC-Type: evil\r\n\r\nbody", "x"), (2_003, "http://é/  WARC-Type: b", "é日本🎉")]
    rows += [(2_004, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (2_005, "u", "\r\n\r\n"), (2_006, "u", "a\r\n\r"), (2_007, "u", "long " * 400_000)]
    rows += [(2_008, "u", "\n"), (2_009, "u", "same id"), (2_009, "u", "same id"), (2_009, "v", "other"), (None, "u", "no id"), (None, "u", "no id"), (3_000, "u", "no id")]
    return rows


def test_records_come_back_whole(spark, work):
    rows = odd_rows()
    _, records = archived(spark, pages(spark, f"{work}/in", rows), f"{work}/out")
    assert rows_of(records) == expected(rows)
    payloads = {(r.page_id, bytes(r.payload)) for r in records.where("record_type = 'response'").collect()}
    assert payloads <= {(i, (html or "").encode()) for i, _, html in rows}
    kinds = {r.page_id: (r.url, r.record_type) for r in records.where("page_id in (2002, 2003)").collect()}
    assert kinds == {2_002: ("http://x/%0D%0AWARC-Type: evil%0D%0A%0D%0Abody", "response"), 2_003: ("http://é/  WARC-Type: b", "response")}


def test_small_payloads_are_never_revisits(spark, work):
    rows = [(i, "u", html) for i, html in enumerate(["", "", "ab", "ab", "abc", "abc", None])]
    _, records = archived(spark, pages(spark, f"{work}/in", rows), f"{work}/out", min_bytes=3)
    assert {r.page_id for r in records.where("record_type = 'revisit'").collect()} == {5}


def test_files_follow_the_format(spark, work):
    _, records = archived(spark, pages(spark, f"{work}/in", [(1, "http://a", "één"), (2, "http://b", "één")]), f"{work}/out")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(f"{work}/out").glob("*.gz")))
    found = {}
    while text:
        head, _, rest = text.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        found[fields["WARC-Type"]] = (fields, rest[:size])
        text = rest[size + 4:]
    response, block = found["response"]
    revisit, empty = found["revisit"]
    assert block == warc.HTTP_HEAD.encode() + "één".encode() and empty == warc.HTTP_HEAD.encode()
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"] != revisit["WARC-Record-ID"]
    assert revisit["WARC-Refers-To-Target-URI"] == "http://a" and revisit["WARC-Profile"] == warc.REVISIT_PROFILE
    assert revisit["WARC-Payload-Digest"] == response["WARC-Payload-Digest"] == f"sha1:{digest('één')}"


def test_payloads_that_are_not_text(spark, work):
    raw = [bytes(range(256)), b"\xff\xfe\r\n\r\n\x00", b""]
    spark.createDataFrame([(str(i), i, "u", b) for i, b in enumerate(raw)], "row string, page_id long, url string, payload binary").write.parquet(f"{work}/in")
    run = warc.write_archives(warc._with_payload_columns(spark.read.parquet(f"{work}/in")), f"{work}/out")
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, f"{work}/out", run).collect()}
    assert got == dict(enumerate(raw))


def test_archives_written_anew_keep_each_payload_once(spark, work):
    first = [(1, "u1", "a"), (2, "u2", "a"), (3, "u3", "b"), (9, "u9", "c")]
    second = [(4, "u4", "b"), (5, "u5", "b"), (6, "u6", "d"), (7, "u7", "c")]
    sources = {}
    for name, rows in (("x", first), ("y", second)):
        run, _ = archived(spark, pages(spark, f"{work}/{name}-in", rows), f"{work}/{name}")
        sources[f"{work}/{name}"] = run
    run = warc.rewrite_archives(spark, sources, f"{work}/all")
    records = warc.read_archives(spark, f"{work}/all", run)
    assert rows_of(records) == expected(first + second)
    old = {r.row for folder, r_ in sources.items() for r in warc.read_archives(spark, folder, r_).collect()}
    assert not old & {r.row for r in records.collect()}


def test_broken_records_are_noticed(spark, work):
    run, records = archived(spark, pages(spark, f"{work}/in", [(1, "u", "a"), (2, "u", "a"), (3, "u", "b")]), f"{work}/out")
    with pytest.raises(Exception, match="no response for"):
        warc.resolve_revisits(records.where("record_type = 'revisit'")).collect()
    for n, file in enumerate(sorted(Path(f"{work}/out").glob("*.gz"))):
        broken = gzip.decompress(file.read_bytes()).replace(b"\r\n\r\nb\r\n", b"\r\n\r\nx\r\n")
        Path(f"{work}/bad").mkdir(exist_ok=True)
        Path(f"{work}/bad/{n}.txt.gz").write_bytes(gzip.compress(broken))
    with pytest.raises(Exception, match="broken record"):
        warc.read_archives(spark, f"{work}/bad", run).collect()


def test_no_pages(spark, work):
    _, records = archived(spark, pages(spark, f"{work}/in", []), f"{work}/out")
    assert rows_of(records) == Counter()


def test_no_python_and_no_payload_in_the_search_for_originals(spark, work):
    records = warc.with_originals(warc.as_records(pages(spark, f"{work}/in", [(1, "u", "a")])))
    plan = spark._jvm.PythonSQLUtils.explainString(records._jdf.queryExecution(), "simple")
    assert not any(word in plan for word in ("Python", "Arrow", "NestedLoop", "Cartesian"))
