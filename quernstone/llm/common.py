"""Shared helpers: reading tables, free column names, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.checkpoints import cut_lineage, shared_folder

__all__ = ["connected_components", "cut_lineage", "free_name", "shared_folder", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def connected_components(edges: DataFrame) -> DataFrame:
    """Label every node of an undirected graph with the smallest node of its component.

    ``edges`` has long columns ``src`` and ``dst``; the result has ``node`` and ``label``, for nodes with an edge.
    Each round takes the smallest label among the neighbours and then jumps to the label's own label, so the
    number of rounds grows with the logarithm of the diameter. Labels stay on the cluster: the driver sees only
    their sum, which falls until nothing changes. Each round's labels are checkpointed, so a lost executor costs
    at most that round. No links, nulls or self-links: no such rows in the result.
    """
    pairs = edges.select("src", "dst").filter("src <> dst")
    both = cut_lineage(pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("label")))
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("s")).first()["s"]
        if now == total:
            return labels
        total = now
        heard = both.join(labels.withColumnRenamed("node", "dst"), "dst").select(F.col("src").alias("node"), "label")
        spread = cut_lineage(heard.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")))
        up = spread.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = cut_lineage(spread.join(up, "label").select("node", F.least("label", "root").alias("label")))
