"""Connected components of a graph given as an edge table.

Each task first contracts the edges it holds to stars, which loses no connectivity. Only nodes that
several tasks saw tie the stars together, and these ties are resolved by alternating star
operations, whose number of rounds grows with the logarithm of the graph. As soon as the remaining
edges are few enough for a fixed bound, one task finishes them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.operators.skew import salted_join
from riftspan.session import reliable_checkpoint

#: Edges that one task may finish on its own, which bounds its nodes by twice as many. A constant, whatever the size of the input.
SINGLE_TASK_EDGES = 500_000
#: Nodes a task keeps in memory before it writes out its stars and starts afresh.
NODES_IN_MEMORY = 1_000_000


def contracting(nodes_in_memory: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Contraction that writes out its stars whenever it holds more nodes than this; with ``None`` only once, at the end."""
    return lambda batches: contract(batches, nodes_in_memory)


def contract(batches: Iterator[pd.DataFrame], nodes_in_memory: int | None = None) -> Iterator[pd.DataFrame]:
    """Replace edges ``(a, b)`` by stars ``(a, b)`` where ``b`` is the least node of the local component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def stars() -> pd.DataFrame:
        nodes = list(parent)
        return pd.DataFrame({"a": nodes, "b": [root(n) for n in nodes]}, dtype="int64")

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if nodes_in_memory is not None and len(parent) > nodes_in_memory:
            yield stars()
            parent.clear()
    if parent:
        yield stars()


def _contracted(edges: DataFrame, nodes_in_memory: int) -> DataFrame:
    """Each task's edges as stars; connected nodes may still have several."""
    return edges.select("a", "b").mapInPandas(contracting(nodes_in_memory), "a bigint, b bigint")


def _finished(edges: DataFrame) -> DataFrame:
    """Final labels of a bounded number of edges, by one task that never lets go of a node."""
    return edges.select("a", "b").coalesce(1).mapInPandas(contracting(None), "a bigint, b bigint")


def _to_minimum(pairs: DataFrame) -> DataFrame:
    """Add to every ``(u, v)`` the least neighbour ``m`` of ``u``, however many neighbours it has."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    return salted_join(pairs, least.select("u", "m"), ["u"], ["v"], counts=least.select("u", "_n"))


def _star_round(edges: DataFrame) -> DataFrame:
    """One large-star step followed by one small-star step; edges point from larger to smaller."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = (
        _to_minimum(both)
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )
    small = _to_minimum(large)
    return (
        small.select("u", F.col("m").alias("v"))
        .unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        .distinct()
        .select(F.col("u").alias("a"), F.col("v").alias("b"))
    )


def _is_forest_of_stars(edges: DataFrame) -> bool:
    per_child = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    parents = edges.select(F.col("b").alias("a")).distinct()
    bad = per_child.filter("n > 1").select("a").unionByName(per_child.select("a").join(parents, "a", "left_semi"))
    return bad.isEmpty()


def _resolve(edges: DataFrame, single_task_edges: int) -> DataFrame:
    """Labels ``(a, b)`` with ``b`` the least node of the component, for a checkpointed edge table."""
    while True:
        if edges.count() <= single_task_edges:
            return _finished(edges)
        edges = reliable_checkpoint(_star_round(edges))
        if _is_forest_of_stars(edges):
            return edges.unionByName(edges.select(F.col("b").alias("a"), "b").distinct())


def connected_components(
    edges: DataFrame, single_task_edges: int = SINGLE_TASK_EDGES, nodes_in_memory: int = NODES_IN_MEMORY
) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b`` bigint); a component is named by its least node.

    The result is a written table.
    """
    stored = reliable_checkpoint(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    if stored.count() <= single_task_edges:
        labels = _finished(stored)
        return reliable_checkpoint(labels.select(F.col("a").alias("node"), F.col("b").alias("component")))
    # Neighbouring ids mostly belong to neighbouring loci, so range partitions cut few components.
    stars = reliable_checkpoint(_contracted(stored.repartitionByRange("b"), nodes_in_memory).distinct())
    per_node = stars.groupBy("a").agg(F.min("b").alias("m"))
    ties = (
        stars.join(per_node, "a")
        .filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    resolved = _resolve(reliable_checkpoint(ties), single_task_edges).select(
        F.col("a").alias("m"), F.col("b").alias("_top")
    )
    # A giant component has one local root per task, so look the roots up with split keys.
    sizes = per_node.groupBy("m").agg(F.count(F.lit(1)).alias("_n"))
    labelled = salted_join(per_node, resolved, ["m"], ["a"], how="left", counts=sizes)
    return reliable_checkpoint(
        labelled.select(F.col("a").alias("node"), F.coalesce("_top", "m").alias("component"))
    )
