import random

import numpy as np
import pytest
from corpusloom.llm import topk_search
from corpusloom.llm.topk_search import top_k
from corpusloom.llm.vectors import integer_vectors

INF, NAN = float("inf"), float("nan")


def _best(vectors: dict, queries: list, k: int) -> list[tuple]:
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def _found(spark, vectors: dict, queries: list, k: int, **more) -> list[tuple]:
    table = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, vector array<long>").repartition(3)
    found = top_k(table, table.filter(table.vec_id.isin(queries)), k, **more)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block", [4, 4096])
def test_equals_all_products(spark, monkeypatch, block):
    rng = random.Random(block)
    kinds = {
        "spread": lambda: [rng.randint(-90, 90) for _ in range(13)],
        "ties": lambda: [rng.randint(-1, 1) for _ in range(3)],
        "one sign": lambda: [-rng.randint(1, 9) for _ in range(5)],
        "few large": lambda: [rng.choice([0, 0, 0, 0, 50, -50, 1, -2]) for _ in range(24)],
        "beyond floats": lambda: [rng.randint(-(1 << 40), 1 << 40) for _ in range(4)],
        "beyond longs": lambda: [rng.choice([-(1 << 63), (1 << 63) - 1, (1 << 62) + rng.randint(0, 3), 0]) for _ in range(3)],
        "lengths": lambda: [rng.randint(-9, 9) for _ in range(rng.randint(0, 6))],
    }
    monkeypatch.setattr(topk_search, "BLOCK", block)  # in this process only; the kernel is tested directly
    for make in kinds.values():
        vectors = {i: make() for i in range(150)}
        width = max(map(len, vectors.values()))
        rows = np.array([v + [0] * (width - len(v)) for v in vectors.values()], np.int64)
        index = topk_search.Shard(np.arange(150), rows)
        got = [(q, r, i, s) for q, ids, scores in index.search(np.arange(0, 150, 7), rows[::7], 5) for r, (i, s) in enumerate(zip(ids, scores, strict=True), 1)]
        assert sorted(got) == _best(vectors, list(range(0, 150, 7)), 5)
    assert _found(spark, vectors, [0, 3, 149], 4, shard_rows=20) == _best(vectors, [0, 3, 149], 4)


def test_copies(spark):
    """A third of the rows hold one vector; their queries find the smallest other ids."""
    rng = random.Random(3)
    vectors = {i: [5, 5, 5] if i % 3 == 0 else [rng.randint(-9, 9) for _ in range(3)] for i in range(90)}
    assert _found(spark, vectors, [0, 30, 50], 5) == _best(vectors, [0, 30, 50], 5)


def test_few_vectors_repeats_and_nulls(spark):
    assert _found(spark, {1: [1, 2]}, [1], 5) == []
    assert _found(spark, {1: [1, 2], 2: [3, 4], 9: []}, [1], 5) == [(1, 1, 2, 11), (1, 2, 9, 0)]
    rows = [(1, [1.0]), (1, [1.0]), (2, [3.0]), (2, [2.0]), (None, [9.0]), (3, None), (4, [None]), (5, [INF]), (6, [NAN]), (7, [-INF, 1.0])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, vector int, shard int")
    vectors = integer_vectors(table, "vec_id")
    assert sorted(tuple(r) for r in top_k(vectors, vectors, 5).collect()) == [(1, 1, 2, 512 * 256), (2, 1, 1, 512 * 256)]
    assert top_k(vectors.limit(0), vectors.limit(0)).collect() == []
    assert top_k(vectors, vectors.limit(0)).collect() == []


def test_floors(spark):
    table = spark.createDataFrame([(1, [0.1, -0.1, -0.0, 1e300, -1e300, 0.99999])], "vec_id long, embedding array<double>")
    assert integer_vectors(table, "vec_id").first().vector == [25, -26, 0, (1 << 63) - 1, -(1 << 63), 255]
