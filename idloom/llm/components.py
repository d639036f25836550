"""Connected components of links between nodes, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for each node of ``edges(a, b)``: comp is the smallest node
    of its component. Every round takes the smallest label around each node and
    then the label of that label, so that long chains shorten quickly. Rounds
    are cut by written tables; a node with many links is pre-aggregated."""
    edges = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(edges.distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "comp"), "b")
        around = around.groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(around, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("via"))
        up = labels.select(F.col("node").alias("via"), F.col("comp").alias("top"))
        new = written(step.join(up, "via").select("node", "old", F.least("via", "top").alias("comp")), "labels")
        if not new.where("old <> comp").limit(1).count():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
