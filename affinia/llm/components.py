"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.sources.workspace import staged


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node that ``links(a, b)`` names.

    Each round points every node at the smallest of itself and its neighbours and
    replaces links by links between those; what has become one node drops out. A star
    is gone after two rounds, and a chain halves in each. All of it is joins and
    aggregates with a row per node, so a hub costs partial minima and a join that
    adaptive execution splits; nothing is gathered per node or on the driver. Rounds
    are written to the work area. No links give no rows; loops and repeats are fine;
    links with a null are left out.
    """
    edges = staged(
        links.where("a is not null and b is not null").select("a", "b").distinct(), "edges"
    )
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = staged(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("parent")), "parents"
        ).withColumnRenamed("a", "node")
        if labels is None:
            labels = parents
        else:
            further = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            labels = staged(
                labels.join(further, "parent", "left").select(
                    "node", F.coalesce("up", "parent").alias("parent")
                ),
                "labels",
            )
        lifted = edges.join(
            parents.select(F.col("node").alias("a"), F.col("parent").alias("low")), "a"
        ).join(parents.select(F.col("node").alias("b"), F.col("parent").alias("high")), "b")
        edges = staged(
            lifted.where("low <> high")
            .select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b"))
            .distinct(),
            "edges",
        )
        # A parent that is not yet smallest keeps a link to the rest of its component,
        # so it is still there in the next round and labels can follow it.
        if edges.isEmpty():
            return labels.withColumnRenamed("parent", "component")
