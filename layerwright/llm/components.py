"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.session import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """For links (a, b) each node with the smallest node it can reach, as (node, root).

    Every round takes the smallest root among a node's neighbours and then the root of that root, until
    nothing changes. Rounds are written to the shared folder. A root that very many nodes share only
    makes the join on roots uneven; both of its sides are plain shuffles that adaptive execution splits.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(both.where("a <> b").distinct())
    roots = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")
    ))
    while True:
        near = (
            edges.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        stepped = cut_lineage(
            roots.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        )
        above = stepped.select(F.col("node").alias("next"), F.col("next").alias("above"))
        jumped = cut_lineage(
            stepped.join(above, "next").select(
                "node", F.least("next", "above").alias("root"), F.col("root").alias("was")
            )
        )
        roots = jumped.drop("was")
        if jumped.where("root <> was").isEmpty():
            return roots
