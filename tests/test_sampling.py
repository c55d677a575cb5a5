"""Sampling, positions and report tables against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import report, sampling
from corpusloom.operators.ordering import add_position, top_rows


def sequential(rows, ratios, limit):
    """ids in training order by the rule written out."""
    if limit <= 0:
        return []
    best = sorted(rows, key=lambda r: (-r[2], -r[3], r[0]))
    if not ratios:
        return [r[0] for r in best[:limit]]
    total = sum(ratios.values()) or 1.0
    out = []
    for source, ratio in ratios.items():
        own = [r for r in best if r[1] == source]
        target = round(limit * (ratio / total))
        if ratio > 0 and own:
            target = max(1, target)
        out += [r[0] for r in own[:target]][: limit - len(out)]
    chosen = set(out)
    return out + [r[0] for r in best if r[0] not in chosen][: limit - len(out)]


@pytest.mark.parametrize(
    "ratios, limit",
    [
        ({"web": 0.35, "document": 0.25, "code": 0.2, "instruction": 0.2}, 40),
        ({"web": 1, "code": 1}, 5),  # 2.5 each: half to even
        ({"code": 0, "absent": 2, "web": 1}, 300),
        ({"web": 0.001, "document": 1000}, 10),
        ({"web": 5, "document": 5, "code": 5}, 2),  # the cap is reached midway
        ({}, 7),
        ({"web": 1}, 0),
    ],
)
def test_sample_by_source_ratio(spark, ratios, limit):
    rng = random.Random(7)
    rows = [(i, rng.choice(["web", "web", "document", "code", "unknown"]), rng.choice([0.5, 0.75, 1.0]), rng.choice([10, 20])) for i in range(200)]
    df = spark.createDataFrame([(o, f"id{o}", s, q, t) for o, s, q, t in rows], "ord bigint, id string, source string, quality_score double, token_count bigint").repartition(5)
    want = sequential(rows, ratios, limit)
    got = sampling.sample_by_source_ratio(df, ratios, limit).orderBy("train_rank").collect()
    assert [r.ord for r in got] == want and [r.train_rank for r in got] == list(range(1, len(want) + 1))


def test_negative_ratios_are_rejected():
    with pytest.raises(ValueError):
        sampling.targets_of({"web": -1}, 10)


def test_rows_with_the_same_id_are_left_out_of_the_back_fill_together(spark):
    rows = [(1, "a", "web", 1.0, 5), (2, "a", "code", 0.9, 5), (3, "b", "code", 0.8, 5)]
    df = spark.createDataFrame(rows, "ord bigint, id string, source string, quality_score double, token_count bigint")
    assert [r.ord for r in sampling.sample_by_source_ratio(df, {"web": 1, "code": 0}, 3).orderBy("train_rank").collect()] == [1, 3]


def test_sample_by_quality(spark):
    df = spark.createDataFrame([(1, False, 0.45), (2, False, 0.4499), (3, True, 1.0)], "ord bigint, filtered boolean, quality_score double")
    assert [r.ord for r in sampling.sample_by_quality(df).collect()] == [1]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    values = list(range(500))
    random.Random(1).shuffle(values)
    # One group holds most rows.
    df = spark.createDataFrame([(v, "hot" if v % 10 else f"g{v % 3}") for v in values], "v bigint, g string").repartition(partitions)
    assert all(r.position == r.v + 1 for r in add_position(df, [F.col("v")]).collect())
    groups = {}
    for r in sorted(add_position(df, [F.col("v").desc()], "p", within="g").collect(), key=lambda r: -r.v):
        groups[r.g] = groups.get(r.g, 0) + 1
        assert r.p == groups[r.g]


def test_top_rows(spark):
    """Any number of rows by any score, overall and by group; the histogram's bins have no say in the result."""
    rng = random.Random(2)
    scores = [None, float("nan"), float("inf"), -float("inf"), -3.5, 0.0, 0.00001, 0.00002, 0.5, 1.0, 7.25]
    rows = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice([*scores, 1.0, 1.0, round(rng.random(), 5)])) for i in range(400)]
    df = spark.createDataFrame(rows, "v bigint, g string, quality_score double").repartition(7)
    order = [F.desc("quality_score"), F.asc("v")]
    # Descending: not a number first, null last.
    rank = lambda r: (r[2] is None, r[2] == r[2], -r[2] if r[2] is not None and r[2] == r[2] else 0, r[0])
    best = sorted(rows, key=rank)
    for k in (0, 1, 37, 250, 400, 20_000):
        got = top_rows(df, order, k, "k").orderBy("k").collect()
        assert [(r.v, r.k) for r in got] == [(r[0], i) for i, r in enumerate(best[:k], 1)]
    takes = {"a": 90, "b": 100_000, "c": 0, "d": 5}
    got = {(r.g, r.k): r.v for r in top_rows(df, order, takes, "k", within="g").collect()}
    assert got == {(g, i): r[0] for g, n in takes.items() for i, r in enumerate([r for r in best if r[1] == g][:n], 1)}


def test_report_tables(spark):
    rows = [(1, "web", 30, 0.9, "high"), (2, "web", 10, 0.5, None), (3, "code", 60, 0.1, "")]
    df = spark.createDataFrame(rows, "train_rank bigint, source string, token_count bigint, quality_score double, quality_bucket string").withColumn("text", F.lit("a  b"))
    assert [tuple(r) for r in report.source_distribution(df).collect()] == [("code", 1, 60, 0.6), ("web", 2, 40, 0.4)]
    assert [tuple(r) for r in report.quality_distribution(df).collect()] == [("high", 1), ("medium", 1), ("low", 1)]
    assert [tuple(r) for r in report.quality_distribution(df.limit(0)).collect()] == [("high", 0), ("medium", 0), ("low", 0)]
    assert [(r.train_rank, r.preview) for r in report.top_samples(df, 2).collect()] == [(1, "a b"), (2, "a b")]
    cleaned = spark.createDataFrame(
        [(1, True, "b", ["x"]), (2, True, "a", ["x", "y"]), (3, True, "", []), (4, False, "", ["y", "x"])], "ord bigint, filtered boolean, filter_reason string, safety_flags array<string>"
    )
    assert [tuple(r) for r in report.filtered_reasons(cleaned).collect()] == [("a", 1), ("b", 1), ("unknown", 1)]
    assert [tuple(r) for r in report.safety_flag_counts(cleaned).collect()] == [("x", 3), ("y", 2)]
    assert tuple(report.report_core(df).first()) == (3, 3, 0, 3, 3, 0.0, 3, 100)
    assert tuple(report.report_core(df, cleaned).first()) == (4, 1, 3, 1, 3, -2.0, 3, 100)
    assert tuple(report.report_core(df, cleaned, 10, {"input_records": 7, "output_records": 5}, 99).first()) == (10, 7, 3, 7, 5, 2 / 7, 3, 99)
