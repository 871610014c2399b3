"""Connected components by min-label propagation with pointer jumping, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvethin.llm import textops as T


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of ``nodes``(id) over ``edges``(a, b).

    Each round takes the smallest label among the neighbours (partial aggregation combines a hub's
    edges map-side) and then the label's own label. Rounds grow with the logarithm of the longest
    path. Labels are checkpointed each round; only a count of changes reaches the driver. Tables are merged by hint: small ones
    would be broadcast anew in each round, by a job of its own each, and the driver holds each broadcast until it collects garbage.
    """
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    both = T.cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(back).distinct())
    # the first round needs no labels: each id still is its own
    first = both.groupBy("v").agg(F.min("u").alias("near")).hint("merge")
    labels = T.cut(nodes.join(first, nodes["id"] == first["v"], "left").select("id", F.least("id", "near").alias("component")))
    while True:
        near = both.join(labels.hint("merge"), both["u"] == labels["id"]).groupBy("v").agg(F.min("component").alias("near"))
        near = near.hint("merge")
        step = labels.join(near, labels["id"] == near["v"], "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("l"))
        jump = labels.select(F.col("id").alias("l"), F.col("component").alias("far")).hint("merge")
        step = T.cut(step.join(jump, "l", "left").select("id", "old", F.least("l", "far").alias("component")))
        labels = step.select("id", "component")
        if step.where("component < old").limit(1).count() == 0:
            return labels
