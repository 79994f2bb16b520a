"""Connected components by alternating large-star and small-star, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfledger.llm.common import counted, small, stored, tasks_for

MAX_ROUNDS = 60
EDGES = 250_000  # for one task to write
BROADCAST_NODES = 1_000_000


def _nodes(edges: DataFrame, tasks: int) -> tuple[DataFrame, bool]:
    """(u, m) for every node, m the smallest of it and its neighbours; whether all edges form stars around smallest nodes.

    They do when no node has two smaller neighbours, or a smaller and a larger one. m is the component then.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.max(F.when(F.col("v") < F.col("u"), F.col("v"))).alias("below")
    )
    seen = Observation()
    near = near.coalesce(tasks).observe(
        seen, F.count(F.lit(1)).alias("nodes"), F.count(F.when((F.col("below") > F.col("least")) | ((F.col("least") < F.col("u")) & (F.col("most") > F.col("u"))), 1)).alias("open"),
    )
    near = stored(near.select("u", F.least("u", "least").alias("m")), "nodes")
    return small(near, seen.get["nodes"], BROADCAST_NODES), not seen.get["open"]


def _large_star(edges: DataFrame, near: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the node's smallest neighbour. Larger nodes come first in the result."""
    up = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return up.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(down: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); the component is its smallest node.

    Each round is written to the shared folder, so lineage stays short and a lost executor repeats
    one round. No edge or component reaches the driver: only counts, taken as a round is written, and
    up to BROADCAST_NODES nodes for a broadcast do.
    """
    edges, rows = counted(links.select("u", "v").filter("u <> v"), "edges")
    for _ in range(MAX_ROUNDS):
        tasks = tasks_for(links.sparkSession, rows, EDGES)
        near, stars = _nodes(edges, tasks)
        if stars:
            return near.select(F.col("u").alias("node"), F.col("m").alias("component"))
        edges, rows = counted(_small_star(_large_star(edges, near)), "edges", tasks)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
