"""The corpus pipeline: toxic documents go, low quality goes, one document of each near-duplicate group stays, and the
rest is packed into sequences.

Each stage takes what its predecessor kept and, but for the last, returns the columns of documents. NULL texts count as
empty; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm import jaccard, packing, quality, toxicity
from millpulse.llm.text import table
from millpulse.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not predict to be toxic; they learn from the labels of these documents."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.where("predicted = 0").select(docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules keeps."""
    return quality.apply_policy(quality.ledger(docs)).where("kept").select(docs.columns)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group; of rows that repeat an id the smallest content stays.

    A text comes before no text. Rows without an id belong to no group and stay.
    """
    grouped = jaccard.near_duplicates(docs.select("doc_id", "text"))
    stay = grouped.where("doc_id = component_id").select("doc_id")
    content = F.struct(F.col("text").isNull().alias("_no_text"), "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    kept = docs.join(stay, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(content).alias("_content"))
    kept = kept.select("doc_id", *[F.col("_content")[c].alias(c) for c in docs.columns if c != "doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull())).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each remaining document goes."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic), ("quality rules", keep_good_quality), ("n-gram Jaccard join", keep_one_per_group),
    ("best-fit packing", pack_sequences),
]

# Neither the toxicity models nor the packing can be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the packing. Every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
