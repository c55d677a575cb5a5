"""Near dedup over blocks of rows of similar size."""

import random

import pytest

from corpusloom.functions import blocks as B
from corpusloom.functions import grams as G
from corpusloom.operators import neardup

from test_dedup import mixed_corpus, sequential


def frame(spark, rows):
    return spark.createDataFrame([(o, f"r{o}", t) for o, t in rows], "ord bigint, id string, text string").repartition(3)


@pytest.mark.parametrize("threshold, index", [(0.85, "rare"), (0.5, None), (0.85, "groups")])
def test_all_indexes_give_the_sequential_result(spark, monkeypatch, threshold, index):
    monkeypatch.setattr(B, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neardup, "FIRST_BUCKET", 3)
    rows = mixed_corpus(7, rows=60, hot=25)
    found = {r.ord: (r.leader_ord, r.similarity) for r in neardup.near_dedup(frame(spark, rows), threshold, index=index).dropped.collect()}
    assert found == sequential(rows, threshold, 5)[0]


def test_unrelated_rows_that_share_rare_members_write_no_pairs(spark, monkeypatch):
    """200 texts of the same words: thousands of pairs share rare members, none reaches a table."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(100))) for i in range(200)]
    rows.append((200, rows[7][1] + " end"))
    written = {}

    def recorded(df, name, write=neardup.materialize):
        table = write(df, name)
        written[name] = written.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(neardup, "materialize", recorded)
    assert [(r.ord, r.leader_ord) for r in neardup.near_dedup(frame(spark, rows), 0.85, index="rare").dropped.collect()] == [(200, 7)]
    import numpy as np

    sets = [G.gram_hashes("".join(t.split()), 5) for _, t in rows]
    tokens = [G.RareTokens(0.85, np.zeros(1 << 20, np.int64))(s)[0] for s in sets]
    assert sum(bool(len(np.intersect1d(a, b))) for i, a in enumerate(tokens) for b in tokens[:i]) > 5000
    assert written["near"] == written["pairs"] == 1 and "met" not in written


def test_folded_words_never_show_more_differences():
    import numpy as np

    rng = np.random.default_rng(4)
    every = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = (np.unique(every[rng.random(4000) < 0.7]) for _ in range(2))
    apart = len(np.setxor1d(a, b))
    both = [B._Block({"n": 1, "smallest": len(s), "largest": len(s), **{c: np.zeros(1, np.int64).tobytes() for c in ("ords", "sizes", "cuts", "counts")}, "parities": G.parities(s), "tokens": b"", "bits": b""}) for s in (a, b)]
    last = 0
    for width in (8, 64, 512, 1024):
        differ = int(np.bitwise_count(both[0].folded(width)[0] ^ both[1].folded(width)[0]).sum())
        assert last <= differ <= apart
        last = differ
    width, words = B._enough(0.081 * 3000, 3000 / 3, 512)
    assert width * 8 >= words * 64 > 2 * 0.081 * 3000 and words < 16


def block_of(sets, tokens_of):
    import numpy as np

    tokens = [(tokens_of.tokens(s) >> np.uint64(32)).astype(np.uint32) for s in sets]
    sizes = np.array([len(s) for s in sets])
    shape = (4, 4 * G.MOST_PARITIES) if tokens_of.t < B.LOOSE else (2, G.MOST_PARITIES)
    return B._Block({
        "n": len(sets), "smallest": int(sizes.min()), "largest": int(sizes.max()), "ords": np.arange(len(sets)).tobytes(), "sizes": sizes.tobytes(), "cuts": np.full(len(sets), B._NO_CUT).tobytes(),
        "counts": np.array([len(t) for t in tokens]).tobytes(), "parities": b"".join(G.parities(s, *shape) for s in sets), "filled": b"".join(np.packbits(G.slot_counts(s) > 0).tobytes() for s in sets),
        "tokens": b"".join(t.tobytes() for t in tokens),
    })


def random_sets(n, sizes=(700, 1000)):
    """Sets that share about a tenth, and copies of earlier ones that lack some members."""
    import numpy as np

    rng = np.random.default_rng(5)
    every = rng.integers(0, 2**63, 9000, dtype=np.uint64)
    sets = []
    for i in range(n):
        if i % 5 == 4:
            sets.append(sets[rng.integers(i)][: rng.integers(*sizes)])
        else:
            sets.append(rng.choice(every, rng.integers(*sizes), replace=False))
    return [np.sort(s) for s in sets]


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7, 0.85])
def test_few_slots_tell_unrelated_rows_apart_and_never_similar_ones(monkeypatch, threshold):
    import numpy as np

    monkeypatch.setattr(B, "STRIP", 7)
    monkeypatch.setattr(B, "SLOTS", 128)
    sets, tokens_of = [s for s in random_sets(60) if len(s) > 512], B.ParityBounds(threshold)
    block = block_of(sets, tokens_of)
    n = len(sets)
    passed = {(int(i), int(j)) for a, b in B._compared(tokens_of, block, block, np.zeros(n, int), np.arange(n)) for i, j in zip(a, b, strict=True) if j < i}
    shared = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(n) for j in range(i)}
    similar = {(i, j) for (i, j), k in shared.items() if k >= threshold * (len(sets[i]) + len(sets[j]) - k)}
    assert similar and similar <= passed
    assert {(hi, int(lo)) for hi, los, _ in B._near(tokens_of, block, block, 100) for lo in los} >= similar
    if threshold >= 0.5:
        assert len(passed) < len(similar) + len(shared) / 20


def test_sets_of_unlike_sizes_need_fewer_words_at_a_low_threshold():
    import numpy as np

    tokens_of = B.ParityBounds(0.5)
    every = np.random.default_rng(6).integers(0, 2**63, 40_000, dtype=np.uint64)
    small, large = (block_of([np.sort(every[k * n : k * n + n]) for k in range(4)], tokens_of) for n in (1000, 1400))
    width, words = B._enough_filled(0.5, small, large, 512)
    assert words < B._enough(800, 2400 / 3, 512)[1] / 2
    apart = np.setdiff1d(every[:1000], every[200:1600])
    alone = small.filled_in(width)[0, :words] & ~block_of([np.sort(every[200:1600])], tokens_of).filled_in(width)[0, :words]
    assert 0 < np.bitwise_count(alone).sum() <= len(apart)


@pytest.mark.parametrize("threshold, met", [(0.85, 1 << 21), (0.7, 1 << 21), (0.85, 50)])
def test_minhash_compares_only_rows_that_share_a_token(monkeypatch, threshold, met):
    import numpy as np

    def never(*_):
        raise AssertionError("all rows are compared")

    monkeypatch.setattr(B, "_compared", never, raising=False)
    monkeypatch.setattr(B, "MET", met)
    tokens_of, sets = G.MinHashTokens(threshold), [s for s in random_sets(60) if len(s) > 512]
    sets += [sets[0][:-k] for k in range(1, 9)] * 9  # a family
    block, tokens = block_of(sets, tokens_of), [set((tokens_of.tokens(s) >> np.uint64(32)).tolist()) for s in sets]
    found = {(int(i), int(j)) for a, b in B._meeting(block, block) for i, j in zip(a, b, strict=True)}
    assert found == {(i, j) for i in range(len(sets)) for j in range(len(sets)) if tokens[i] & tokens[j]}
    first = {hi: los.tolist() for hi, los, _ in B._near(tokens_of, block, block, 4)}
    assert first[len(sets) - 1][0] == 0 and len(first[len(sets) - 1]) == 4
