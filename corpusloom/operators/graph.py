"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import materialize, ship_package

TASK_EDGES = 1 << 22  # edges that one task joins up in its memory


class Forest:
    """Disjoint sets of integers, each named by its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent, path = self.parent, []
        while (up := parent.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for node in path:
            parent[node] = x
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _joined_up(edges: DataFrame) -> DataFrame:
    """(a, b): the edges of each partition as stars; a is the smallest node of what its partition connects."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.join(a, b)
        nodes = [x for x, up in forest.parent.items() if x != up]
        for start in range(0, len(nodes), 100_000):
            part = nodes[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([forest.root(x) for x in part], pa.int64()), pa.array(part, pa.int64())], names=["a", "b"])

    return ship_package(edges).select("a", "b").mapInArrow(step, "a long, b long")


def _hung(edges: DataFrame, upper: bool) -> DataFrame:
    """Hang a node's neighbours below the smallest of them and itself: those above it, or else those below it and the node.

    Doing one after the other halves the paths; edges are (a, b) with a < b, and stay so.
    """
    if upper:
        around = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    else:
        around = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    least = around.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    found = around.join(least, "node")
    if upper:
        hung = found.filter("other > node").select("least", "other")
    else:
        hung = found.select("least", "other").union(least.select("least", "node"))
    return hung.toDF("a", "b").filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge (a, b); root is the smallest node that it is connected with.

    Each task joins up the edges that it holds and leaves one per node at most, which is all there is to do while one task can hold them.  Larger
    graphs alternate that with two star steps, so the number of rounds is logarithmic even if no task shortens anything.
    """
    edges = edges.select("a", "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    state = None
    while True:
        size, mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        tasks = -(-size // TASK_EDGES)
        if (size, mark) == state:
            break
        if tasks <= 1:
            edges = materialize(_joined_up(edges.coalesce(1)), "stars")
            break
        state = size, mark
        edges = materialize(_joined_up(edges.repartition(tasks, "a")), "stars")
        edges = materialize(_hung(edges, upper=True), "stars")
        edges = materialize(_hung(edges, upper=False), "stars")
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots.select("a", "a"))
