"""Connected components of a link table, for graphs of any size.

Contraction: in every round each node moves to its smallest neighbour (or
stays, if it is smaller itself), where "smallest" goes by a seeded hash of the
node, so that a long chain shrinks by a constant factor as well. Links are
rewritten to the new nodes, loops and repeats drop out, and the round's moves
are followed by all nodes. Every round's tables are written to the shared
folder; the driver only sees a row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: 64-bit).

    ``component`` is one of the component's nodes, the same for all of them.
    Loops and repeated links do no harm; no links give an empty table.
    """
    def ranked(node: str, seed: int):
        return F.struct(F.xxhash64(F.lit(seed), node).alias("rank"), F.col(node).alias("node"))

    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage_table(both.filter("a <> b").distinct(), "cc-links")
    labels = stage_table(links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
                         .withColumn("component", F.col("node")), "cc-labels")
    seed = 0
    while not edges.isEmpty():
        seed += 1
        moves = stage_table(
            edges.groupBy("a").agg(F.min(ranked("b", seed)).alias("least"))
            .select("a", F.least("least", ranked("a", seed))["node"].alias("to")),
            "cc-moves")
        labels = stage_table(
            labels.join(moves, labels.component == moves.a, "left")
            .select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
        left = moves.select(F.col("a"), F.col("to").alias("a2"))
        right = moves.select(F.col("a").alias("b"), F.col("to").alias("b2"))
        edges = stage_table(
            edges.join(left, "a").join(right, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
            .filter("a <> b").distinct(), "cc-links")
    return labels
