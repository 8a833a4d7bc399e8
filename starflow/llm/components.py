"""Distributed union-find: connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import drop_folder, keep, shared_folder


# Edges beyond which the least neighbours are stored before they are joined. Both sides of the join
# are then shuffled, and adaptive execution can split a node with very many neighbours; with fewer
# edges the extra job costs more than such a node does. The result is the same.
SPLIT_ROWS = 1_000_000


def components(
    edges: DataFrame, a: str = "a", b: str = "b", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """``(node, root)`` for every node of an edge, the root being the least node it can reach.

    In turns, the larger neighbours of each node are linked to its least neighbour, and then the
    node and its smaller neighbours are. The number of rounds grows with the logarithm of the
    nodes, edges never multiply, and each round is written to the shared folder, so no lineage
    grows. Nodes may be of any type that has an order. Rows with a NULL and loops are left out. An
    empty table gives no rows.
    """
    spark = edges.sparkSession
    links = _canonical(edges.select(F.col(a).alias("u"), F.col(b).alias("v")))
    links, folder = _written(links)
    many = links.count() > split_rows  # the number never grows
    while not _are_stars(links):
        # Large star: every larger neighbour of a node goes to the least neighbour.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        if many:
            at = shared_folder(spark, "components")
            least = keep(least, "components", at)
        large = _canonical(
            both.filter(F.col("v") > F.col("u"))
            .join(least.hint("merge"), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = _canonical(small.unionByName(least.select("u", F.col("m").alias("v"))))
        old = folder
        links, folder = _written(after)
        drop_folder(spark, old)
        if many:
            drop_folder(spark, at)
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _canonical(links: DataFrame) -> DataFrame:
    """Each link once, from the greater node ``u`` to the lesser ``v``."""
    kept = links.filter(F.col("u") != F.col("v"))
    return kept.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether each node has one lesser neighbour or is such a neighbour, and not both."""
    upper = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    lower = links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = upper.unionByName(lower).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter(F.col("up") + F.col("down") > 1).isEmpty()


def _written(links: DataFrame) -> tuple[DataFrame, str]:
    folder = shared_folder(links.sparkSession, "components")
    return keep(links, "components", folder), folder
