"""Connected components by repeated contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.store import keep


def components(edges: DataFrame) -> DataFrame:
    """node, label (the same for connected nodes) for the nodes of edges (a, b).

    Each round sends every node to the least among itself and its neighbours and
    keeps the edges between different images; a path halves in each round. A hot
    node is pre-aggregated, as only minima are taken."""
    edges = keep(edges.select("a", "b").where("a <> b").distinct(), "edges")
    total = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        image = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
        image = keep(image, "image")
        if total is None:
            total = image
        else:
            old = total.withColumnRenamed("label", "mid")
            new = image.select(F.col("node").alias("mid"), F.col("label").alias("next"))
            total = keep(old.join(new, "mid", "left").select("node", F.coalesce("next", "mid").alias("label")), "labels")
        left = image.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = image.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = edges.join(left, "a").join(right, "b").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
        edges = keep(edges.where("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return total
