"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node that has edges (u, v).

    Grouping by a hash beside the node makes the join that follows deal this side
    out anew, so that the adaptive planner may split a node with very many edges.
    """
    return (
        edges.groupBy("u", F.hash("u").alias("h"))
        .agg(F.min("v").alias("m"))
        .select("u", F.least("u", "m").alias("m"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(_least(both), "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    others = (
        edges.join(least, "u")
        .filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edge table (u, v); the root is the
    smallest node of its component.

    Loops and edges with a null end are ignored, direction and repeats do not
    matter. Every round is written to the shared folder, which cuts the lineage
    and outlives lost executors. The number of rounds grows with the logarithm of
    the longest path; ``max_rounds`` only guards against a fault and raises.
    """
    now = stored(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state["n"] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
