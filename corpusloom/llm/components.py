"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node below the smallest of them and the node; ``pairs`` lists a node's neighbours.

    With ``larger`` only the neighbours above the node move, else the neighbours below it and the node itself.
    The minimum is combined before the shuffle, so the neighbours of a hub never meet in one task.
    """
    lowest = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    moved = pairs.join(lowest, "a")
    if larger:
        out = moved.filter(F.col("b") > F.col("a")).select(F.col("low").alias("a"), "b")
    else:
        own = lowest.select(F.col("low").alias("a"), F.col("a").alias("b"))
        out = moved.select(F.col("low").alias("a"), "b").union(own)
    return out.filter(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b): root is the component's smallest node.

    Alternating large and small stars shorten every path by halves, so the number of rounds grows with the
    logarithm of the longest path.  Each round is written to the shared folder, which cuts the lineage in a way
    that survives lost executors.  Edges may repeat; edges with a null end or equal ends are no edges.
    """
    edges = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    state = _state(edges)
    while True:
        wide = materialize(_star(_both_ways(edges), larger=True), "edges")
        edges = materialize(_star(wide.select(F.col("b").alias("a"), F.col("a").alias("b")), larger=False), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)
