"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (x, y): root is the smallest node reachable.

    Every round hangs each node below its smallest neighbour, halves the paths, and goes on with the
    links between different parents, so a chain of n nodes takes about log2(n) rounds. Rows with a null
    end and loops are no links; no links give an empty result.
    """
    edges = stored(
        links.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "edges"
    )
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parents = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("near"))
        parents = stored(parents.select("node", F.least("node", "near").alias("parent")), "parents")
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        step = stored(parents.join(above, "parent").select("node", "root"), "step")
        if roots is None:
            roots = step
        else:
            later = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
            roots = stored(
                roots.join(later, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
            )
        of_x = step.select(F.col("node").alias("x"), F.col("root").alias("rx"))
        of_y = step.select(F.col("node").alias("y"), F.col("root").alias("ry"))
        edges = stored(
            edges.join(of_x, "x")
            .join(of_y, "y")
            .where("rx <> ry")
            .select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y"))
            .distinct(),
            "edges",
        )
        if edges.isEmpty():
            return roots
