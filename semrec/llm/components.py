"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of ``edges`` (``a``, ``b``); equal labels are connected.

    Each round maps a node to its smallest neighbour's smallest neighbour (an
    aggregation with map-side combine, then one join) and renames both ends of
    every edge, until no edge is left.  Nodes are expected to be well mixed
    numbers, so chains shrink by a constant factor per round.  Links, labels and
    edges stay in tables; only "is any edge left" reaches the driver.
    """
    e = frozen(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                            F.greatest("a", "b").alias("b")).distinct())
    labels = (e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
              .withColumn("label", F.col("node")))
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        near = frozen(both.groupBy(F.col("a").alias("x"))
                      .agg(F.min("b").alias("b")).select("x", F.least("x", "b").alias("up")))
        far = near.select(F.col("x").alias("up"), F.col("up").alias("top"))
        top = frozen(near.join(far, "up").select("x", "top"))
        labels = frozen(labels.join(top, labels["label"] == top["x"], "left")
                        .select("node", F.coalesce("top", "label").alias("label")))
        one = top.select(F.col("x").alias("a"), F.col("top").alias("ta"))
        two = top.select(F.col("x").alias("b"), F.col("top").alias("tb"))
        e = frozen(e.join(one, "a").join(two, "b").where("ta <> tb")
                   .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                   .distinct())
    return labels
