"""Lineage over the tiers: which files a publication rests on, and what a file reached.

Every step adds edges from what it read to what it wrote: file to Bronze batch,
Bronze batch to the Silver versions that hold it, Silver version to the
publications made of it. Nodes are (kind, name). The closure follows the edges.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakejobs.session import materialize, path_status
from lakejobs.sources.ledger import FileLedger

EDGES = "from_kind string, from_name string, to_kind string, to_name string"
Node = tuple[str, str]


def edges_of(spark: SparkSession, sources: Iterable[Node], target: Node) -> DataFrame:
    """Edges of one step: from everything it read to what it wrote."""
    return spark.createDataFrame([(*s, *target) for s in sources], EDGES)


def landing_edges(spark: SparkSession, ledger: FileLedger) -> DataFrame:
    """File to Bronze batch, for the files that count."""
    return ledger.current(spark).select(
        F.lit("file").alias("from_kind"),
        F.col("file").alias("from_name"),
        F.lit("bronze").alias("to_kind"),
        F.col("batch").alias("to_name"),
    )


def append_edges(edges: DataFrame, path: str) -> None:
    """Add edges; the same edge again does no harm."""
    edges.select("from_kind", "from_name", "to_kind", "to_name").write.mode("append").parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    if path_status(spark, path) == "absent":
        return spark.createDataFrame([], EDGES)
    return spark.read.schema(EDGES).parquet(path).distinct()


def version_edges(spark: SparkSession, table: str, version: int, batches: Iterable[str]) -> DataFrame:
    """Edges of a table's version (from 1): what its own batches and the versions before it add.

    A version's state rests on all versions up to it. A chain would be as deep as
    the history, and edges from every earlier version would grow with its square.
    So versions form blocks, as in a binary indexed tree: the block of v covers
    the last 2**k versions, 2**k being the largest power that divides v, and a
    state is the blocks along v without its lowest bits. A version adds a few
    edges, and no path is longer than about twice the bits of v.
    """
    if version < 1:
        raise ValueError("versions start at 1")
    block, state = ("block", f"{table}/{version}"), ("state", f"{table}/{version}")
    into = [("bronze", b) for b in batches]
    step = 1
    while version % (2 * step) == 0:
        into.append(("block", f"{table}/{version - step}"))
        step *= 2
    rest = version & (version - 1)
    below = [block] + ([("state", f"{table}/{rest}")] if rest else [])
    return edges_of(spark, into, block).unionByName(edges_of(spark, below, state))


def closure(edges: DataFrame, targets: DataFrame, up: bool = True) -> DataFrame:
    """(kind, name, at_kind, at_name): all that each target rests on, or leads to with up=False.

    targets has kind and name; they are among their own results. Each round takes
    one step from the nodes that the round before has found, and is written to
    the shared folder, so there are as many rounds as the longest path has edges.
    Cycles end, since nodes that are known are not found again.
    """
    a, b = ("to", "from") if up else ("from", "to")
    steps = edges.select(
        F.struct(F.col(f"{a}_kind").alias("kind"), F.col(f"{a}_name").alias("name")).alias("x"),
        F.struct(F.col(f"{b}_kind").alias("kind"), F.col(f"{b}_name").alias("name")).alias("y"),
    ).distinct()
    steps = materialize(steps, "lineage-steps")
    start = targets.select(F.struct("kind", "name").alias("target")).distinct()
    front = materialize(start.withColumn("x", F.col("target")), "lineage")
    reach = front
    while not front.isEmpty():
        found = front.join(steps, "x").select("target", F.col("y").alias("x")).distinct()
        front = materialize(found.join(reach, ["target", "x"], "left_anti"), "lineage")
        reach = reach.unionByName(front)
    return reach.select(
        "target.kind", "target.name", F.col("x.kind").alias("at_kind"), F.col("x.name").alias("at_name")
    )
