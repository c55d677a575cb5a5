import random

import numpy as np
import pytest
from corpusloom.llm.vector_codes import assign, codebooks_digest, encode, label_errors

NAN = float("nan")


def _plain(rows: list[tuple], parts: int, entries: int, rounds: int):
    """Every distance of every part; rows (vec_id, vector of integers)."""
    width = max(1, -(-max(len(v) for _, v in rows) // parts))
    full = [v + [0] * (parts * width - len(v)) for _, v in rows]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in full]
    first = [c for _, _, c in sorted(((i is not None, i or 0), v, c) for (i, v), c in zip(rows, cut, strict=True))][:entries]
    books = [[c[p] for c in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            held = [[] for _ in book]
            for c in cut:
                held[nearest(c[p], book)[1]].append(c[p])
            new.append([[sum(x) // len(own) for x in zip(*own, strict=True)] if own else entry for own, entry in zip(held, book, strict=True)])
        books = new
    last = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(i, bytes(e for _, e in found), min(sum(d for d, _ in found), (1 << 63) - 1)) for (i, _), found in zip(rows, last, strict=True)], books


def _coded(spark, rows, parts, entries, rounds, partitions=3):
    table = spark.createDataFrame([(i, [x / 256 for x in v], 1, "c") for i, v in rows], "vec_id long, embedding array<double>, label int, codes string")
    coded, books = encode(table.repartition(partitions), parts, entries, rounds)
    return sorted(((r.vec_id, bytes(r.codes), r.error) for r in coded.collect()), key=repr), books


@pytest.mark.parametrize("kind", ["spread", "ties", "clusters", "one vector", "large", "lengths", "one part"])
def test_equals_plain_rounds(spark, kind):
    rng = random.Random(kind)
    make = {
        "spread": lambda: [rng.randint(-90, 90) for _ in range(12)],
        "ties": lambda: [rng.randint(-1, 1) for _ in range(8)],
        "clusters": lambda: [100 * rng.randint(0, 3) + rng.randint(0, 2) for _ in range(8)],
        "one vector": lambda: [3, -4, 5, 6],
        "large": lambda: [rng.randint(-(1 << 45), 1 << 45) for _ in range(8)],
        "lengths": lambda: [rng.randint(-9, 9) for _ in range(rng.randint(0, 7))],
        "one part": lambda: [rng.randint(-40, 40) for _ in range(3)],
    }[kind]
    rows = [(rng.choice([i, i, i, i // 2, None]), make()) for i in range(200)]
    shape = (1, 16, 3) if kind == "one part" else (4, 9, 2)
    want, books = _plain(rows, *shape)
    got, own = _coded(spark, rows, *shape)
    assert own == books and got == sorted(want, key=repr)


def test_rings_give_the_nearest_entry():
    """From any entry that a point is in, also after several rounds of moves."""
    rng = np.random.default_rng(5)
    for spread in (2, 30, 1000):
        points, entries = rng.integers(-spread, spread, (500, 3)), rng.integers(-spread, spread, (20, 3))
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        for own in (np.zeros(500, np.int64), rng.integers(0, 20, 500), every.argmin(axis=1)):
            codes, away = assign(points, own, entries, np.ones(20, bool))
            assert (codes == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()
        moved = np.zeros(20, bool)
        moved[3] = True
        entries[3] += spread
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        codes, away = assign(points, codes, entries, moved)
        assert (codes == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()


def test_left_out_rows_and_labels(spark):
    rows = [(1, [0.5, 1.0], 7), (2, [0.0, 0.0], None), (3, [9.0, 9.0], None), (4, None, 7), (5, [NAN, 1.0], 7), (6, [None, 1.0], 1), (7, [0.25, 0.0], 7), (1, [0.5, 1.0], 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    coded, books = encode(table, parts=2, entries=2, rounds=1)
    # Both entries start as (128, 256); the first of equal ones takes the parts of all five rows.
    assert books == [[[524], [128]], [[563], [256]]]
    errors = {r.vec_id: r.error for r in coded.collect()}
    assert errors == {1: 0, 2: 128**2 + 256**2, 3: (2304 - 524) ** 2 + (2304 - 563) ** 2, 7: 64**2 + 256**2}
    assert {r.its_label: r.label_error for r in label_errors(coded).collect()} == {7: errors[7], None: errors[2] + errors[3]}
    assert encode(table.limit(0))[0].collect() == [] and codebooks_digest([]) == codebooks_digest([[]])
    assert encode(table.filter("vec_id = 4"))[0].collect() == []
