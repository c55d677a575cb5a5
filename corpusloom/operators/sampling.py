"""Sampling by quality and by source quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.frames import materialize
from corpusloom.operators.ordering import top_rows


def best_first() -> list:
    """Higher score, then more tokens, then input order."""
    return [F.desc("quality_score"), F.desc("token_count"), F.asc("ord")]


def sample_by_quality(df: DataFrame, min_score: float = 0.45) -> DataFrame:
    return df.filter(~F.col("filtered") & (F.col("quality_score") >= float(min_score)))


def targets_of(ratios: dict[str, float], max_records: int) -> dict[str, int]:
    """Rows each source asks for.  Python's ``round`` sends halves to the even neighbour."""
    if any(float(r) < 0 for r in ratios.values()):
        raise ValueError("source ratios must not be negative")
    total = sum(float(r) for r in ratios.values()) or 1.0
    return {s: max(int(round(max_records * (float(r) / total))), 1 if r > 0 else 0) for s, r in ratios.items()}


def source_quotas(df: DataFrame, ratios: dict[str, float], max_records: int) -> DataFrame:
    """(source, place, target, available, take, taken_before), one row per configured source.

    Quotas are served in the order of ``ratios`` until ``max_records`` are taken.  What a source cannot
    deliver goes to the back-fill, not to the next source.
    """
    spark = df.sparkSession
    asked = [(s, i, t) for i, (s, t) in enumerate(targets_of(ratios, max_records).items())]
    asked = spark.createDataFrame(asked, "source string, place int, target bigint")
    available = df.groupBy("source").agg(F.count("*").alias("available"))
    # One row per configured source from here on.
    served = asked.join(available, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    wanted = F.least("target", "available")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    served = served.withColumn("taken_before", F.least(F.coalesce(F.sum(wanted).over(before), F.lit(0)), F.lit(max_records)))
    return served.withColumn("take", F.least(wanted, F.lit(max_records) - F.col("taken_before")))


def sample_by_source_ratio(df: DataFrame, ratios: dict[str, float] | None, max_records: int) -> DataFrame:
    """The training sample with ``train_rank`` (1-based output order).

    Only (ord, id, source, score, tokens) is ranked; the wide rows are fetched at the end.
    """
    narrow = df.select("ord", "id", "source", "quality_score", "token_count")
    if max_records <= 0:
        picked = narrow.limit(0).select("ord", F.lit(0).cast("bigint").alias("train_rank"))
    elif not ratios:
        picked = top_rows(narrow, best_first(), max_records, "train_rank").select("ord", "train_rank")
    else:
        picked = _by_quota(narrow, ratios, max_records)
    return df.join(picked, "ord")


def _by_quota(narrow: DataFrame, ratios: dict[str, float], max_records: int) -> DataFrame:
    spark = narrow.sparkSession
    quotas = source_quotas(narrow, ratios, max_records).collect()  # as many rows as the configuration has sources
    frame = spark.createDataFrame([(q.source, q.taken_before) for q in quotas], "source string, taken_before bigint")
    ranked = top_rows(narrow, best_first(), {q.source: q.take for q in quotas}, "rank", within="source").join(F.broadcast(frame), "source")
    picked = ranked.select("ord", "id", (F.col("taken_before") + F.col("rank")).alias("train_rank"))

    taken = sum(q.take for q in quotas)
    if taken < max_records:
        picked = materialize(picked, "picked")
        rest = narrow.join(picked.select("id"), "id", "left_anti")
        filled = top_rows(rest, best_first(), max_records - taken, "train_rank")
        picked = picked.select("ord", "train_rank").union(filled.select("ord", F.col("train_rank") + taken))
    return picked.select("ord", F.col("train_rank").cast("bigint").alias("train_rank"))


def sampling_metrics(candidates: DataFrame, sampled: DataFrame, max_records: int) -> DataFrame:
    return candidates.agg(F.count("*").alias("quality_candidates")).join(
        sampled.agg(F.count("*").alias("train_records"), F.lit(max_records).cast("bigint").alias("max_records"))
    )
