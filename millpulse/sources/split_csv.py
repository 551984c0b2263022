"""Read one large CSV file by many tasks, although quoted cells may hold line breaks.

Files are read line by line in splits. A line break is part of a cell when the quotes before it in the file are odd in number. Each
stretch of a split reports its lines with an odd number of quotes; the sum over the stretches before it tells how a stretch begins, and
the first and last such line which of its lines belong to a record that reaches over its edges. Lines outside quotes before the first and
behind the last go straight on. Only lines between them are shuffled, once, and put in order within their stretch, where a running sum
tells records apart; only lines of records over an edge are gathered across stretches.

Counting quotes is right when quotes stand around whole cells and are doubled inside them. Files with other quotes are found
by checking every record, and are left to the reader that takes a file in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LOOSE_FILES = 1_000
STRETCH_BITS = 18  # at most 2^18 lines are put in order together


def _lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(files)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", odd.cast("long").alias("odd"),
    ).withColumn("part", F.shiftright("line", STRETCH_BITS))


def _stretches(lines: DataFrame) -> DataFrame:
    """A row per stretch, named by its first line: the odd lines before and in it, the first and last of them, the header of its file."""
    blank = F.rtrim("value", F.lit("\r")) == ""
    found = lines.groupBy("file", "block", "part").agg(
        F.min("line").alias("stretch"), F.sum("odd").alias("odd_lines"),
        F.min(F.when(F.col("odd") == 1, F.col("line"))).alias("first_odd"), F.max(F.when(F.col("odd") == 1, F.col("line"))).alias("last_odd"),
        F.min(F.when(~blank, F.col("line"))).alias("first_line"),
        F.min(F.struct("line", F.endswith("value", F.lit("\r")).alias("crlf"))).alias("start"),
    )
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(
        "file", "block", "part", "stretch", "odd_lines", "first_odd", "last_odd", F.coalesce(F.sum("odd_lines").over(earlier), F.lit(0)).alias("odd_before"),
        F.min(F.when(F.col("first_line").isNotNull(), F.struct("block", "first_line"))).over(of_file)["first_line"].alias("header"),
        F.min(F.struct("block", "start")).over(of_file)["start"]["crlf"].alias("crlf"),
    )


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: p["value"]), "\n")


def csv_records(spark: SparkSession, files: str | list[str], quotes_only: bool = False) -> DataFrame:
    """(file, record) of all files, without their header and without empty lines; a record may span lines.

    With `quotes_only` lines without a quote may be empty, which is enough to judge the quotes of records.
    """
    lines = _lines(spark, files)
    stretches = _stretches(lines)
    # A row per quarter of a million lines is small; a broadcast keeps the lines where they are.
    placed = lines.join(F.broadcast(stretches), ["file", "block", "part"])
    no_odd = F.col("odd_lines") == 0
    begins_inside = F.col("odd_before") % 2 == 1
    ends_inside = (F.col("odd_before") + F.col("odd_lines")) % 2 == 1
    up_to_first, from_last = no_odd | (F.col("line") <= F.col("first_odd")), no_odd | (F.col("line") >= F.col("last_odd"))
    before_first, behind_last = no_odd | (F.col("line") < F.col("first_odd")), no_odd | (F.col("line") > F.col("last_odd"))
    is_head, is_tail = begins_inside & up_to_first, ends_inside & from_last
    is_straight = (~begins_inside & before_first) | (~ends_inside & behind_last)
    is_header = F.coalesce(F.col("line") == F.col("header"), F.lit(False))
    straight = placed.where(is_straight & ~is_header).select("file", "crlf", F.col("value").alias("record"))

    # A record over an edge: its opening line has an even number of odd lines before it, the others of it one more.
    number = F.floor(F.when(is_head, F.col("odd_before")).otherwise(F.col("odd_before") + F.col("odd_lines")) / 2)
    over_edges = (
        placed.where(is_head | is_tail).groupBy("file", "crlf", number.alias("number"))
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value", is_header.alias("is_header")))).alias("parts"))
        .where("not parts[0].is_header").select("file", "crlf", _joined(F.col("parts")).alias("record"))
    )
    # What is left of a stretch begins and ends outside quotes.
    kept = F.when(F.contains("value", F.lit('"')), F.col("value")).otherwise("") if quotes_only else F.col("value")
    inner = placed.where(~(is_straight | is_head | is_tail)).select("stretch", "line", kept.alias("value"), "odd").repartition("stretch")
    in_order = Window.partitionBy("stretch").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("before", F.coalesce(F.sum("odd").over(in_order), F.lit(0)))
    alone = (F.col("before") % 2 == 0) & (F.col("odd") == 0)
    whole = inner.where(alone).select("stretch", "line", F.col("value").alias("record"))
    gathered = (
        inner.where(~alone).groupBy("stretch", F.floor(F.col("before") / 2).alias("number"))
        .agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
        .select("stretch", F.col("parts")[0]["line"].alias("line"), _joined(F.col("parts")).alias("record"))
    )
    within = whole.unionByName(gathered).join(F.broadcast(stretches.select("stretch", "file", "crlf", "header")), "stretch")
    records = straight.unionByName(over_edges).unionByName(within.where(~is_header).select("file", "crlf", "record"))
    # Where lines end in two characters, the reader of whole files turns line breaks in cells into one.
    ended = F.when(F.col("crlf"), F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r\\z", "")).otherwise(F.col("record"))
    return records.select("file", ended.alias("record")).where("record <> ''")


def loose_quotes(record: Column) -> Column:
    """Whether a record has quotes that do not stand around whole cells."""
    single = F.replace(record, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, '(^|,)"[^"]*"(?=,|$)', "$1")
    return F.contains(record, F.lit('"')) & F.contains(rest, F.lit('"'))


def read_split_csv(spark: SparkSession, files: str | list[str], schema: T.StructType, options: dict[str, str], trust_quotes: bool = False) -> DataFrame:
    """The rows of all files by position, as the CSV reader gives them with the same `schema` of texts and `options`.

    The records are checked for loose quotes first, which reads the files once more; `trust_quotes` leaves that out.
    """
    records = csv_records(spark, files)
    loose = []
    if not trust_quotes:
        found = csv_records(spark, files, quotes_only=True).where(loose_quotes(F.col("record"))).select("file").distinct().limit(MAX_LOOSE_FILES + 1).collect()
        loose = [row.file for row in found]
        if len(loose) > MAX_LOOSE_FILES:
            raise ValueError(f"more than {MAX_LOOSE_FILES} files have quotes that do not stand around whole cells")
    cells = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    rows = records.where(~F.col("file").isin(loose)) if loose else records
    rows = rows.select(cells.alias("cells")).select("cells.*")
    if loose:
        rows = rows.unionByName(spark.read.schema(schema).options(**options).csv(loose))
    return rows
