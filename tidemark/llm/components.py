"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``; longs).

    The component is its smallest node.  Each round hooks every node to its
    smallest neighbour if that is smaller, doubles the pointers until they
    reach roots, and contracts the links to links between roots.  A round at
    least halves the trees that still have links, so rounds and doublings are
    logarithmic.  A node's links are only ever aggregated or joined, never
    gathered.
    """
    spark = edges.sparkSession
    links = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    labels = None
    while not links.isEmpty():
        parent = (links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
                  .groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("up")))
        parent = written(parent, "parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = written(parent.join(above, "up").select("node", F.col("top").alias("up"),
                                                             (F.col("top") != F.col("up")).alias("moved")), "parents")
            parent = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select("node", F.col("up").alias("component"))
        else:
            step = parent.select(F.col("node").alias("component"), F.col("up").alias("next"))
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("next", "component").alias("component"))
        labels = written(labels, "labels")
        up_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        up_b = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        links = written(links.join(up_a, "a").join(up_b, "b").filter("ua <> ub")
                        .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "links")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels
