"""Web archives without repeated payloads: one response for each payload, and revisit records that point to it.

Only headers are shuffled by payload digest to find the first record of each repeated payload; records then learn by a join
whether they are that one. The join is salted, so a payload that a third of all records share is spread over many tasks.
Archives are written by Spark's text writer, one record a row, so any file system will do and a lost task leaves nothing
behind. A header of its own run follows each record's version line; together they are the separator that archives are read
by, and no payload can hold it.

An archive that is written anew has fresh record ids, dates, lengths and references; nothing of the old ones is copied.
Everything is column expressions.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.operators.joins import salted_join

# Fixed values of the format.
VERSION = "WARC/1.1"
NEWLINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

RUN_HEADER = "X-Archive-Run"
PAGE_HEADER = "X-Page-Id"
RECORDS_PER_FILE = 50_000  # a compressed file is read by one task
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_digest(payload: Column) -> Column:
    """SHA-1 of the bytes in upper-case base32, without a prefix."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def _with_payload_columns(records: DataFrame) -> DataFrame:
    """Length, digest and key of the payload; payloads are equal when their keys are, which hold SHA-1 and SHA-256."""
    measured = records.withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": payload_digest(F.col("payload")),
    })
    return measured.withColumn("payload_key", F.concat("payload_digest", F.lit(":"), F.sha2("payload", 256)))


def as_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(row, page_id, url, payload, payload_bytes, payload_digest, payload_key): every row is a record, NULL html an empty payload.

    `row` tells rows of one id apart. It is the reading position, so `pages` must come straight from stored files.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    row = F.format_string("%016x", F.monotonically_increasing_id())
    return _with_payload_columns(pages.select(
        row.alias("row"), F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ))


def with_originals(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add `original` (row, page_id, url), the record that this one repeats, or NULL for a record that keeps its payload.

    The original is, of the records that have the payload, the one with the smallest page id; a NULL id comes last, and rows
    that share an id come in the order of `row`. Payloads below `min_bytes` are never repeats.
    """
    keyed = records.withColumn("_same", F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_key")))
    holder = F.when(F.col("payload").isNotNull(), F.struct(F.col("page_id").isNull().alias("_unnamed"), "page_id", "row", "url"))
    repeated = keyed.where("_same is not null").groupBy("_same").agg(F.min(holder).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    repeated = repeated.where("_copies > 1").select("_same", "_first")  # headers only, and only of payloads that repeat
    found = salted_join(keyed, repeated, "_same", ["row"])
    original = F.when(F.col("_first.row") != F.col("row"), F.struct("_first.row", "_first.page_id", "_first.url"))
    return found.withColumn("original", original).drop("_same", "_first")


def write_archives(
    records: DataFrame, path: str, run: str | None = None, at: datetime | None = None, min_bytes: int = 0
) -> str:
    """Write `records` (see `as_records`) as gzipped archives in the folder `path` and return the name of the run.

    Each record is a response with its payload, or a revisit that names the record it repeats. `run` makes the record ids,
    so it must differ between archives; `at` is the date of the records. Line ends in an address are escaped, since they would end its header.
    """
    run = run or uuid.uuid4().hex
    date = (at or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    marked = with_originals(records, min_bytes)
    repeats = F.col("original").isNotNull()
    head = F.lit(HTTP_HEAD)
    # Payloads are bytes; the text writer takes the bytes of a string as they are.
    block = F.when(repeats, head).otherwise(F.concat(head, F.col("payload").cast("string")))
    size = F.when(repeats, F.lit(len(HTTP_HEAD)).cast("long")).otherwise(F.col("payload_bytes") + len(HTTP_HEAD))
    lines = [
        ("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_id(run, F.col("row"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _one_line(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(repeats, REVISIT_PROFILE)),
        ("WARC-Refers-To", F.when(repeats, _record_id(run, F.col("original.row")))),
        ("WARC-Refers-To-Target-URI", F.when(repeats, _one_line(F.col("original.url")))),
        ("WARC-Refers-To-Date", F.when(repeats, F.lit(date))),
        (PAGE_HEADER, F.col("page_id").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", size.cast("string")),
    ]
    # concat_ws leaves out the headers that are NULL. The writer ends each row with the last line feed.
    headers = F.concat_ws(NEWLINE, *[F.concat(F.lit(f"{name}: "), value) for name, value in lines])
    record = F.concat(F.lit(_separator(run)), headers, F.lit(NEWLINE * 2), block, F.lit(NEWLINE + "\r"))
    out = marked.select(record.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.text(path)
    return run


def read_archives(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The records of the archives of one run: their headers, and the payload of responses.

    (record_type, row, page_id, url, date, payload, payload_bytes, payload_digest, payload_key, refers_to_row). `row` is the
    record id. A response whose length or payload does not agree with its headers fails the job.
    """
    text = spark.read.option("lineSep", _separator(run)).text(path).where("value <> ''")
    split = text.select(F.substring_index("value", NEWLINE * 2, 1).alias("head"), F.col("value").cast("binary").alias("whole"))

    def header(name: str) -> Column:
        # Only line feeds end a line here; an address may hold other line separators.
        return F.nullif(F.regexp_extract("head", rf"(?md)^{name}: ([^\r\n]*)", 1), F.lit(""))

    size = header("Content-Length").cast("long")
    start = F.octet_length("head") + len(NEWLINE * 2) + len(HTTP_HEAD) + 1
    payload = F.substring("whole", start, F.greatest(size - len(HTTP_HEAD), F.lit(0)).cast("int"))
    kind = header("WARC-Type")
    taken = _with_payload_columns(split.select(
        kind.alias("record_type"), header("WARC-Record-ID").alias("row"), header(PAGE_HEADER).cast("long").alias("page_id"),
        header("WARC-Target-URI").alias("url"), header("WARC-Date").alias("date"), header("WARC-Refers-To").alias("refers_to_row"),
        F.when(kind == "response", payload).alias("payload"), size.alias("_size"),
        F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "").alias("_digest"),
    ))
    sound = (F.col("payload_bytes") + len(HTTP_HEAD) == F.col("_size")) & (F.col("payload_digest") == F.col("_digest"))
    broken = F.raise_error(F.concat(F.lit("broken record "), F.col("row"))).cast("long")
    checked = F.when((F.col("record_type") == "revisit") | sound, F.col("payload_bytes")).otherwise(broken)
    return taken.withColumns({"payload_bytes": checked, "payload_digest": F.col("_digest")}).drop("_size", "_digest")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """The records with `refers_to`, the page id of the response that a revisit names, and that response's length and key.

    Only headers of responses that are named at all meet the revisits. A revisit whose response is not there, or has another
    digest, fails the job.
    """
    responses, revisits = records.where("record_type = 'response'"), records.where("record_type = 'revisit'")
    named = revisits.select(F.col("refers_to_row").alias("row")).distinct()
    originals = responses.select("row", "page_id", "payload_bytes", "payload_digest", "payload_key").join(named, "row", "left_semi").select(
        F.col("row").alias("refers_to_row"), F.struct("page_id", "payload_bytes", "payload_digest", "payload_key").alias("_named")
    )
    joined = salted_join(revisits, originals, "refers_to_row", ["row"])
    lost = F.raise_error(F.concat(F.lit("no response for "), F.col("row"))).cast("long")
    agrees = F.col("_named.payload_digest") == F.col("payload_digest")
    resolved = joined.withColumns({
        "payload_bytes": F.when(agrees, F.col("_named.payload_bytes")).otherwise(lost),
        "payload_key": F.col("_named.payload_key"), "refers_to": F.col("_named.page_id"),
    }).drop("_named")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(resolved)


def rewrite_archives(spark: SparkSession, sources: dict[str, str], path: str, **options) -> str:
    """Write the records of all `sources` (run by folder) as one set of archives and return its run.

    Revisits are resolved first, so that payloads that repeat across the sources are kept once, whichever archive has them.
    """
    parts = [resolve_revisits(read_archives(spark, source, run)) for source, run in sources.items()]
    return write_archives(reduce(DataFrame.unionByName, parts), path, **options)


def _separator(run: str) -> str:
    return f"{VERSION}{NEWLINE}{RUN_HEADER}: {run}{NEWLINE}"


def _record_id(run: str, row: Column) -> Column:
    """A name-based id: the same record of the same run has the same id wherever it is made."""
    return F.regexp_replace(
        F.sha2(F.concat(F.lit(f"{run}:"), row.cast("string")), 256),
        "^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$", "<urn:uuid:$1-$2-8$3-a$4-$5>",
    )


def _one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
