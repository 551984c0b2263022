"""CSV batches whose headers differ, each landed exactly once.

A batch is written below the folder of its landing day, in a folder of its own header and batch:
`year=/month=/day=/header=/batch=`. Its commit, a small file written last, names the header and the days. Readers follow the
commits, so a batch that failed half way does not show, and one that is repeated replaces its folders and counts once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.sources import storage
from millpulse.sources.raw import CSV_OPTIONS
from millpulse.sources.tables import CSV_WRITE_OPTIONS

MAX_HEADERS = 1_000
FILE_RECORDS = 500_000  # rows of one landed file; cells may hold line breaks, so a file is read by one task
_COMMIT = "batch string, header string, keys array<string>, days array<string>"


def header_name(keys: list[str]) -> str:
    return hashlib.sha256(json.dumps(keys).encode()).hexdigest()[:16]


def write_batch(rows: DataFrame, path: str, batch: str, keys: list[str], cell: Callable[[str], Column]) -> None:
    """Land rows whose text for a key is `cell(key)`, by their column `day` (`year=/month=/day=`); `batch` names them for good.

    Key names that differ only by case need a case-sensitive session.
    """
    header = header_name(keys)
    days = sorted(row.day for row in rows.select("day").distinct().collect())  # one, as a rule
    for day in days:
        of_day = rows.where(F.col("day") == day).select(*[cell(key).alias(key) for key in keys])
        of_day.write.mode("overwrite").option("maxRecordsPerFile", FILE_RECORDS).options(**CSV_WRITE_OPTIONS).csv(f"{path}/{day}/header={header}/batch={batch}")
    commit = {"batch": batch, "header": header, "keys": keys, "days": days}
    storage.write_json(rows.sparkSession, f"{path}/commits/{batch}.json", commit)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(batch, header, keys, days) of every batch that counts."""
    if not storage.children(spark, f"{path}/commits"):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).json(f"{path}/commits/*.json")


def load_landed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed CSV batches, whose headers differ from batch to batch, as text columns matched by name.

    A column that a batch lacks is NULL. Batches of one header are read together. The distinct headers reach the driver, and
    more than MAX_HEADERS of them are an error; names of files or batches do not.
    """
    commits = committed(spark, path)
    headers = commits.groupBy("header").agg(F.first("keys").alias("keys")).orderBy("header").limit(MAX_HEADERS + 1).collect()
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers below {path}")
    # A folder counts when the commit of its batch names its day.
    counted = commits.select("batch", F.explode("days").alias("day")).select(F.concat_ws("/", "day", "batch").alias("_place"))
    tables = []
    for header, keys in headers:
        schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
        rows = spark.read.schema(schema).options(**CSV_OPTIONS).csv(f"{path}/year=*/month=*/day=*/header={header}/batch=*")
        found = F.regexp_extract(F.col("_metadata.file_path"), "(year=[^/]*/month=[^/]*/day=[^/]*)/header=[^/]*/batch=([^/]*)/", 0)
        place = F.regexp_replace(found, "header=[^/]*/batch=([^/]*)/$", "$1")
        # All cells move as one value, since a key may have any name.
        cells = rows.select(place.alias("_place"), F.struct(*[rows[f"`{key.replace('`', '``')}`"] for key in keys]).alias("_cells"))
        tables.append(cells.join(counted, "_place", "left_semi").select("_cells.*"))
    if not tables:
        return spark.createDataFrame([], T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
