"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b): label is the component's least node.

    Alternates two steps until nothing changes: every node sends its larger
    neighbours to its least neighbour, then its smaller ones. The least neighbour is a
    partial aggregate and meets the edges in an equi-join that Spark may split,
    so a node with very many neighbours is no single task's work. Each round is
    written to the checkpoint folder, which cuts the lineage; only two numbers
    come to the driver. Edges with a null end and loops link nothing.
    """
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = store(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # Larger neighbours go to the least of the node and its neighbours.
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        # Smaller neighbours, and the node itself, go to the least one.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        links = store(small)
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("u"), "v").distinct()
    return links.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("label"))
