"""Connected components of an edge table, by alternating star steps.

Each round links every node to the smallest node it knows; rounds are written
to the shared folder, so lineage stays short and nothing reaches the driver but
two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.session import materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    Nodes are any ordered type. Loops and repeated edges do no harm; edges with
    a null end are ignored. An empty edge table gives an empty result.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    now = materialize(now, "edges")
    seen = None
    while True:
        now = materialize(small_star(large_star(now)), "edges")
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
