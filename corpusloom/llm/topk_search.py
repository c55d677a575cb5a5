"""Exact top-k inner-product search by MaxScore.

A vector is a document and its dimensions are its terms: the posting list of a dimension holds every vector's component, and a query's
term adds at most max(q * highest, q * lowest) to a score.  Of a query's terms, ordered by that bound, the *non-essential* ones are
the longest tail whose bounds sum up to no more than the score of the k-th best vector so far: a vector that has gained nothing from the
essential terms can't enter the result.  The postings of the essential terms are traversed, and what is still competitive probes the
others, the largest bounds first, until its bound falls below the k-th score too.

The vectors are dealt into shards by their id; each shard is one index in a task's memory, of a bounded number of
vectors, cut into blocks with bounds of their own.  The queries are sent to every shard as a stream, a block at a time, and a query's best k of
all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.rows import in_arrow
from corpusloom.llm.vectors import clamped, largest, matrix

SHARD = 1 << 16  # vectors of a shard, on average at most
BLOCK = 4096  # vectors that share bounds
TOGETHER = 256  # queries that are scored in one step
PROBED = 8  # terms that are probed between two looks at the bounds


class Shard:
    """An index of vectors with different ids, in ascending order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.width, self.most = vectors.shape[1], largest(vectors)
        self.blocks = [(ids[i : i + BLOCK], np.ascontiguousarray(vectors[i : i + BLOCK].T)) for i in range(0, len(ids), BLOCK)]
        self.exact: dict = {}  # the blocks' postings by the type that holds a query's scores exactly

    def _postings(self, most: int) -> tuple[type, list]:
        """Blocks as (ids, postings, highest and lowest of each term) in the smallest type that no score leaves."""
        score = most * self.most * max(self.width, 1)
        kind = np.float32 if score < 1 << 24 else np.float64 if score < 1 << 53 else object
        if kind not in self.exact:
            typed = [(ids, postings.astype(kind)) for ids, postings in self.blocks]
            self.exact = {kind: [(ids, p, p.max(axis=1), p.min(axis=1)) for ids, p in typed]}
        return kind, self.exact[kind]

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, list[int], list]]:
        """(query id, vector ids, scores) of each query's best k vectors with other ids, best first, equal scores by id."""
        wide = np.zeros((len(ids), self.width), np.int64)
        shared = min(self.width, queries.shape[1])
        wide[:, :shared] = queries[:, :shared]
        kind, blocks = self._postings(largest(wide))
        for start in range(0, len(ids), TOGETHER):
            part = wide[start : start + TOGETHER].astype(kind)
            names = ids[start : start + TOGETHER]
            best = [(np.empty(0, kind), np.empty(0, np.int64)) for _ in names]
            for block in blocks:
                self._visit(block, names, part, best, k)
            for name, (scores, found) in zip(names, best, strict=True):
                yield int(name), found.tolist(), clamped(scores)

    def _visit(self, block: tuple, names: np.ndarray, queries: np.ndarray, best: list, k: int) -> None:
        ids, postings, highest, lowest = block
        bounds = np.maximum(queries * highest, queries * lowest)
        order = np.argsort(-bounds, axis=1, kind="stable")
        rest = np.zeros((len(names), self.width + 1), bounds.dtype)  # what the terms from here on add at most
        rest[:, :-1] = np.cumsum(np.take_along_axis(bounds, order, axis=1)[:, ::-1], axis=1)[:, ::-1]
        filling = [i for i, (scores, _) in enumerate(best) if len(scores) < k]  # all terms are essential
        if filling:
            for i, scores in zip(filling, queries[filling] @ postings, strict=True):
                self._enter(best, i, scores, ids, names[i], k)
        for i in sorted(set(range(len(names))) - set(filling)):
            floor = best[i][0][-1]
            small = np.flatnonzero(rest[i] <= floor)
            essential = int(small[0]) if len(small) else self.width
            if not essential:
                continue
            terms = order[i, :essential]
            scores = queries[i, terms] @ postings[terms]
            alive = np.flatnonzero(scores + rest[i, essential] > floor)
            scores = scores[alive]
            for at in range(essential, self.width, PROBED):
                if not len(alive):
                    break
                terms = order[i, at : at + PROBED]
                scores = scores + queries[i, terms] @ postings[np.ix_(terms, alive)]
                competitive = scores + rest[i, min(at + PROBED, self.width)] > floor
                alive, scores = alive[competitive], scores[competitive]
            if len(alive):
                self._enter(best, i, scores, ids[alive], names[i], k)

    @staticmethod
    def _enter(best: list, i: int, scores: np.ndarray, ids: np.ndarray, name: int, k: int) -> None:
        """Ids ascend from block to block, so a stable sort by score leaves equal scores in order of their ids."""
        others = ids != name
        scores = np.concatenate([best[i][0], scores[others]])
        found = np.concatenate([best[i][1], ids[others]])
        chosen = np.argsort(-scores, kind="stable")[:k]
        best[i] = scores[chosen], found[chosen]


def _search(shards: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) for rows (shard, is_query, vec_id, vector), in this order inside of each partition."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, vectors, index = None, [], [], None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            kinds = batch.column("is_query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin == end:
                    continue
                if numbers[begin] != shard:
                    shard, ids, vectors, index = numbers[begin], [], [], None
                names = batch.column("vec_id")[begin:end].to_numpy()
                found = batch.column("vector")[begin:end]
                if not kinds[begin]:
                    first = np.ones(end - begin, bool)  # of the rows with one id
                    first[1:] = names[1:] != names[:-1]
                    first[0] = not ids or ids[-1][-1] != names[0]
                    if first.any():
                        ids.append(names[first])
                        vectors.append(found.filter(pa.array(first)))
                    continue
                if index is None and ids:
                    index = Shard(np.concatenate(ids), matrix(pa.concat_arrays(vectors)))
                    vectors = []
                if index:
                    rows = [(name, i, s) for name, best, scores in index.search(names, matrix(found), k) for i, s in zip(best, scores, strict=True)]
                    arrays = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3
                    yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    return in_arrow(shards, step, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` rows of ``vectors`` with the highest inner product.

    Both are rows (vec_id long, vector array<bigint>).  Equal scores go to the smaller vec_id; rank starts at 1.  A query never
    finds its own vec_id; with fewer other vectors it finds them all.  Rows with a null id or vector take no part; of several rows with one id the one
    with the smallest vector counts.  Vectors of different lengths are compared as if the shorter had zeros behind, so an empty
    vector scores 0.  A score beyond 64 bits becomes the largest or smallest long (its order is still exact).  Empty tables give an empty result.

    A shard holds about ``shard_rows`` vectors at most, and there are as many as the session has cores at least.
    """
    spark = vectors.sparkSession
    named = "vec_id IS NOT NULL AND vector IS NOT NULL"
    shards = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // shard_rows))
    held = vectors.filter(named).select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("is_query"), "vec_id", "vector")
    asked = queries.filter(named).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_query"), "vec_id", "vector")
    dealt = held.union(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "is_query", "vec_id", "vector")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = _search(dealt, k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")
