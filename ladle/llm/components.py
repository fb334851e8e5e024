"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, work: str) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the label is the least node of its component.

    ``work`` is a new folder that all workers share; each round is written there, so
    lineage stays short and lost executors cost a round at most. A label that has
    settled needs as many rounds as the logarithm of the component's width, about.
    """
    spark = links.sparkSession
    links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct().write.parquet(f"{work}/links")
    both = spark.read.parquet(f"{work}/links")
    both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")).write.parquet(f"{work}/labels-0")
    step = 0
    while True:
        labels = spark.read.parquet(f"{work}/labels-{step}")
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("via"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("jumped"))
        lower.join(jump, "via").select("node", F.least("via", "jumped").alias("label"), "was").write.parquet(f"{work}/labels-{step + 1}")
        step += 1
        labels = spark.read.parquet(f"{work}/labels-{step}")
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")
