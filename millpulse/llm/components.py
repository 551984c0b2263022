"""Connected components of links between ids, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.session import work_dir


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is the smallest node reachable.

    Each round a node takes the smallest label among its neighbours, and then the label of that label, so a chain
    shortens by more than half in two rounds. Every round is written to the shared folder, which cuts the lineage.
    A node with very many links costs no more than others: minima are taken in each task first. No links, no rows.
    """
    spark = links.sparkSession
    folder = work_dir(spark, "components")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both.write.parquet(f"{folder}/links")
    both = spark.read.parquet(f"{folder}/links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    turn = 0
    while True:
        labels.write.parquet(f"{folder}/{turn}")
        labels = spark.read.parquet(f"{folder}/{turn}")
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        moved = labels.join(heard, "node").select("node", "component", F.least("component", "heard").alias("next"))
        roots = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = moved.join(roots, "next", "left").select("node", F.least("next", F.coalesce("beyond", "next")).alias("component"), F.col("component").alias("old"))
        moved.write.parquet(f"{folder}/{turn}-moved")
        moved = spark.read.parquet(f"{folder}/{turn}-moved")
        if moved.where("component <> old").isEmpty():
            return labels
        labels = moved.select("node", "component")
        turn += 1
