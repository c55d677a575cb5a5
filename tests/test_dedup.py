"""Deduplication against the sequential rule, written out in plain Python."""

import random

import pytest


from corpusloom.functions import grams as G
from corpusloom.operators import neardup
from corpusloom.operators.dedup import dedup_rollup, exact_dedup


def grams(text, n):
    v = "".join(text.lower().split())
    return set() if not v else {v} if len(v) <= n else {v[i : i + n] for i in range(len(v) - n + 1)}


def similarity(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def sequential(rows, threshold, n):
    """(dropped {ord: (leader, similarity)}, comparisons)"""
    kept, dropped, comparisons = [], {}, 0
    for o, text in sorted(rows):
        g = grams(text, n)
        for leader, other in kept:
            comparisons += 1
            s = similarity(g, other)
            if s >= threshold:
                dropped[o] = (leader, s)
                break
        else:
            kept.append((o, g))
    return dropped, comparisons


def check(spark, rows, threshold, n=5, method="exact"):
    df = spark.createDataFrame([(o, f"r{o}", t) for o, t in rows], "ord bigint, id string, text string").repartition(3)
    result = neardup.near_dedup(df, threshold, n, method)
    dropped = {r.ord: (r.leader_ord, r.similarity) for r in result.dropped.collect()}
    want, comparisons = sequential(rows, threshold, n)
    assert dropped == want
    assert {r.ord for r in result.kept.collect()} == {o for o, _ in rows} - set(want)
    stats = result.stats.first()
    assert (stats.input_records, stats.output_records, stats.duplicates_removed) == (len(rows), len(rows) - len(want), len(want))
    assert stats.comparisons == comparisons
    pairs = {(r.record_id, r.duplicate_of, r.similarity) for r in result.pairs.collect()}
    assert pairs == {(f"r{o}", f"r{leader}", round(s, 4)) for o, (leader, s) in want.items()}


def edited(rng, text, share):
    chars = list(text)
    for _ in range(int(len(chars) * share)):
        chars[rng.randrange(len(chars))] = rng.choice("abcdefghijklmnopqrstuvwxyz")
    return "".join(chars)


def mixed_corpus(seed, rows=120, hot=40):
    """Unrelated texts, families of edited copies, and one family that holds a third of all rows."""
    rng = random.Random(seed)
    fresh = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    base = fresh(400)
    texts = [edited(rng, base, rng.choice([0, 0, 0.005, 0.01, 0.02])) for _ in range(hot)]
    while len(texts) < rows:
        family = fresh(rng.choice([3, 20, 60, 300]))
        texts += [edited(rng, family, rng.choice([0, 0.01, 0.02])) for _ in range(rng.randrange(1, 4))]
    texts += ["", "  \n", "ab", "AB", "abcd e"]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_exact_dedup(spark):
    df = spark.createDataFrame([(1, "a", "Hello   World"), (2, "b", "hello world"), (3, "c", "Different text"), (4, "d", " HELLO\nworld ")], "ord bigint, id string, text string")
    result = exact_dedup(df)
    assert sorted(r.ord for r in result.kept.collect()) == [1, 3]
    assert all(len(r.dedup_signature) == 32 for r in result.kept.collect())
    assert sorted(tuple(r) for r in result.duplicates.collect()) == [(2, "b", "a"), (4, "d", "a")]
    assert tuple(result.stats.first()) == ("md5_exact", 4, 2, 2)
    again = exact_dedup(result.kept.drop("dedup_signature"))
    assert again.stats.first().duplicates_removed == 0
    assert dedup_rollup(0, 0)["duplicate_rate"] == 0 and dedup_rollup(4, 3)["duplicate_rate"] == 0.25


def test_chain_keeps_both_ends(spark):
    a = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(1, a), (2, a[3:]), (3, a[6:]), (4, "something else entirely")]
    threshold = 0.92
    g = [grams(t, 5) for _, t in rows]
    assert similarity(g[0], g[1]) >= threshold <= similarity(g[1], g[2]) and similarity(g[0], g[2]) < threshold
    check(spark, rows, threshold)


@pytest.mark.parametrize("threshold", [0.85, 0.6])
def test_near_dedup_in_one_round(spark, threshold):
    check(spark, mixed_corpus(1), threshold)


@pytest.mark.parametrize("threshold, first, growth", [(0.85, 3, 2), (0.93, 2, 2), (0.6, 4, 3)])
def test_crowded_buckets_take_rounds(spark, monkeypatch, threshold, first, growth):
    monkeypatch.setattr(neardup, "FIRST_BUCKET", first)
    monkeypatch.setattr(neardup, "GROWTH", growth)
    check(spark, mixed_corpus(2, rows=70, hot=30), threshold)


def test_minhash_candidates(spark):
    check(spark, mixed_corpus(3, rows=60, hot=20), 0.85, method="minhash")


@pytest.mark.parametrize("threshold", [0.0, 1.0, 1.5])
def test_extreme_thresholds(spark, threshold):
    check(spark, mixed_corpus(4, rows=30, hot=10), threshold)


def test_no_rows(spark):
    df = spark.createDataFrame([], "ord bigint, id string, text string")
    assert neardup.near_dedup(df).stats.first().input_records == 0


def test_similar_sets_share_a_token():
    """The guarantee behind the exact mode, without Spark: over many sizes, right at the threshold."""
    import numpy as np

    rng = np.random.default_rng(5)
    for threshold in (0.3, 0.5, 0.7, 0.85, 0.95, 1.0):
        tokens = G.PigeonholeTokens(threshold)
        for _ in range(300):
            size = int(rng.integers(1, 400))
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            # Replace as many members, or drop as many, as the threshold allows.
            most = int((1 - threshold) * size + 1e-9) if rng.random() < 0.5 else int((1 - threshold) / (1 + threshold) * size + 1e-9)
            b = a[most:] if rng.random() < 0.5 else np.concatenate([a[most:], rng.integers(0, 2**63, int((1 - threshold) / (1 + threshold) * size), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if not len(b) or len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < threshold:
                continue
            (ta, shape_a, _), (tb, shape_b, _) = tokens(a), tokens(b)
            shared = len(np.intersect1d(ta, tb))
            assert shared, (threshold, size, most)
            differences = int((1 - threshold) / (1 + threshold) * (len(a) + len(b)) + 1e-6)
            common = {c for c, filled in zip((shape_a[0], shape_a[0] + 1), shape_a[1:], strict=True) if filled} & {c for c, filled in zip((shape_b[0], shape_b[0] + 1), shape_b[1:], strict=True) if filled}
            schemes = [max(shape_a[1 + c - shape_a[0]], shape_b[1 + c - shape_b[0]]) for c in common]
            assert shared >= sum(max(filled - differences, 0) for filled in schemes)


def test_gram_hashes_follow_the_grams():
    for text in ("", "abc", "abcde", "abcdef", "aaaaaaaaaa", "😀éab中文字"):
        assert len(G.gram_hashes(text, 5)) == len(grams(text, 5))
    assert G.gram_hashes("abcde", 5)[0] in G.gram_hashes("abcdef", 5)



def test_parities_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(6)
    for _ in range(300):
        every = rng.integers(0, 2**63, int(rng.integers(1, 3000)), dtype=np.uint64)
        a, b = (np.unique(every[rng.random(len(every)) < rng.random()]) for _ in range(2))
        apart = len(np.setxor1d(a, b))
        differ = G.differing(G.parities(a), G.parities(b))
        assert differ <= apart and (apart - differ) % 2 == 0
        if apart > 60 and len(b) < 2 * len(a) < 4 * len(b):
            assert differ > apart / 5


def test_a_drifting_chain_is_decided_in_one_walk(spark, monkeypatch):
    """2,000 texts, each like the ones next to it only: the number of written tables doesn't follow the chain's length."""
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2000 * 12 + 200))
    rows = [(i, text[12 * i : 12 * i + 200]) for i in range(2000)]
    tables = []
    from corpusloom.operators import graph

    for module in (neardup, graph):
        monkeypatch.setattr(module, "materialize", lambda df, name, write=module.materialize: tables.append(name) or write(df, name))
    df = spark.createDataFrame([(o, f"r{o}", t) for o, t in rows], "ord bigint, id string, text string").repartition(3)
    dropped = {r.ord: r.leader_ord for r in neardup.near_dedup(df, 0.85).dropped.collect()}
    g = [grams(t, 5) for _, t in rows]
    want: dict[int, int] = {}
    for i in range(2000):
        leader = next((j for j in range(max(0, i - 3), i) if j not in want and similarity(g[j], g[i]) >= 0.85), None)
        if leader is not None:
            want[i] = leader
    assert dropped == want and len(want) > 900 and len(tables) <= 30
    assert similarity(g[0], g[1]) >= 0.85 > similarity(g[0], g[2])


def test_components(spark, monkeypatch):
    from corpusloom.operators import graph

    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    forest = graph.Forest()
    for a, b in edges:
        forest.join(a, b)
    want = {x: forest.root(x) for a, b in edges for x in (a, b) if a != b}
    for most in (1 << 22, 100):  # one task, and rounds of several
        monkeypatch.setattr(graph, "TASK_EDGES", most)
        df = spark.createDataFrame(edges + [(b, a) for a, b in edges[:20]], "a long, b long").repartition(4)
        assert {r.node: r.root for r in graph.components(df).collect()} == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_tokens_travel_in_packs_of_few_bytes():
    """A set of 1,500 members has at most .34 tokens a member, and a token moves in fewer than 9 bytes (24 and more as a row of its own)."""
    import numpy as np

    rng = np.random.default_rng(12)
    tokens_of, parts = G.PigeonholeTokens(0.85), 7
    sets = {o: np.unique(rng.integers(0, 2**63, 1500, dtype=np.uint64)) for o in (-5, 3, 4, 900, 2**56 + 1)}
    tokens = {o: tokens_of(g)[0] for o, g in sets.items()}
    for places in (False, True):
        packer = G._Packer(parts, places)
        for o in reversed(sets):
            packer.add(o, len(sets[o]), tokens[o])
        packs = [p for batch in packer.packed() for p in batch.to_pylist()]
        found, size = set(), 0
        for pack in packs:
            size += sum(len(pack[c]) for c in ("ords", "sizes", "counts", "places", "tokens"))
            rows = G._unpacked(pack, places)
            assert set(rows["size"]) == {1500}
            found |= {(int(o), int(t) % 2**32, int(p)) for o, t, p in zip(rows["ord"], rows["token"], rows["place"], strict=True)}
        want = {(o, int(t) % 2**32, i if places else 0) for o, ts in tokens.items() for i, t in enumerate(ts)}
        n = sum(map(len, tokens.values()))
        assert found == want and n < 0.34 * 5 * 1500 and size < (13 if places else 9) * n


def test_rows_with_the_same_key_or_none(spark):
    text = "the quick brown fox jumps over the lazy dog near the river bank " * 3
    rows = [(1, text), (1, text), (2, text + "!"), (None, text + "?"), (3, "something else entirely")]
    df = spark.createDataFrame([(o, f"r{o}", t) for o, t in rows], "ord bigint, id string, text string")
    result = neardup.near_dedup(df)
    assert {(r.ord, r.leader_ord) for r in result.dropped.collect()} == {(2, 1)}
    assert sorted(str(r.ord) for r in result.kept.collect()) == ["1", "1", "3", "None"]


def test_pairs_travel_in_packs_of_few_bytes():
    """A pair that met leaves its task in fewer than 16 bytes, with the number of tokens that its sizes call for; sets of one class meet in its own scheme alone."""
    import numpy as np

    rng = np.random.default_rng(13)
    tokens_of, cells = G.PigeonholeTokens(0.85), 5
    every = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    sets = [np.unique(np.r_[every[int(rng.integers(0, 60)) :], rng.integers(0, 2**63, 20, dtype=np.uint64)]) for _ in range(60)]
    tokens = [tokens_of(s)[0] for s in sets]
    token = np.concatenate(tokens).view(np.int64)
    of = np.repeat(np.arange(len(sets)), [len(t) for t in tokens])
    order = np.lexsort((of, token))
    ords = np.arange(len(sets)) * 1000 - 3
    size = np.array([len(s) for s in sets])
    rows = {"token": token[order], "ord": ords[of[order]], "size": size[of[order]], "place": np.zeros(len(of), np.int64)}
    buckets = G._Buckets(tokens_of, 128, 4, cells)
    rows |= {"facts": rows["size"] << 32, "gone": np.zeros(len(of), bool)}
    packs = [p for step in (buckets.read(rows), buckets.close(), buckets.flushed(1)) for batch in step for p in batch.to_pylist()]
    seen = {}
    for pack in packs:
        found = G._unpacked_pairs(pack)
        assert set(G._cells(found["lo"], cells)) == {pack["cell"]}
        seen |= {(lo, hi): (n, need) for lo, hi, n, need in zip(*(found[c].tolist() for c in ("lo", "hi", "seen", "need")), strict=True)}
    one_class = len({tokens_of._class_of(int(n)) for n in size}) == 1
    shared = {(a, b): len(np.intersect1d(tokens[a], tokens[b])) for a in range(60) for b in range(a)}
    for (a, b), n in shared.items():
        alike = len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) >= 0.85
        met = seen.get((int(ords[b]), int(ords[a])))
        assert not alike or met and met[0] >= met[1]
        assert met is None or met[0] < n or not one_class or not tokens_of.facts(token, size[of])["upper"].any()
    assert len(seen) > 1000 and sum(len(p[c]) for p in packs for c in ("los", "counts", "his", "seen", "need", "left")) < 16 * len(seen)
