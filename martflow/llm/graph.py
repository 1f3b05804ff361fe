"""Connected components of large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) reaches.

    Every round takes the smallest label among the neighbours and then the label
    of that label, so long chains shorten quickly. Each round is written to the
    shared folder, both as the cut of the lineage and so that joins read plain
    tables, whose hot nodes Spark can split.
    """
    ends = settle(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select(F.col("b"), F.col("a"))).distinct(),
        "ends",
    )
    labels = settle(
        ends.groupBy("node").agg(F.min("other").alias("other"))
        .select("node", F.least("node", "other").alias("component")),
        "labels",
    )
    while True:
        heard = ends.join(labels.withColumnRenamed("node", "other"), "other").select("node", "component")
        near = settle(
            heard.union(labels).groupBy("node").agg(F.min("component").alias("component")), "near"
        )
        jump = near.select(F.col("node").alias("component"), F.col("component").alias("_far"))
        moved = settle(near.join(jump, "component").select("node", F.col("_far").alias("component")), "labels")
        changed = moved.join(labels.withColumnRenamed("component", "_old"), "node").where("component <> _old")
        if changed.isEmpty():
            return moved
        labels = moved
