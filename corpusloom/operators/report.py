"""Tables of the data-quality report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import patterns as P
from corpusloom.functions import text as X
from corpusloom.functions.rounding import python_round


def source_distribution(df: DataFrame) -> DataFrame:
    """source, record_count, token_count, token_share (4 digits), by source name."""
    sums = df.groupBy("source").agg(F.count("*").alias("record_count"), F.sum("token_count").alias("token_count"))
    total = F.sum("token_count").over(Window.partitionBy())  # over one row per source
    share = python_round(X.ratio(F.col("token_count"), total), 4)
    return sums.withColumn("token_share", share).orderBy("source")


def filtered_reasons(cleaned: DataFrame) -> DataFrame:
    """filter_reason, count; most frequent first."""
    reason = F.coalesce(F.nullif(F.col("filter_reason"), F.lit("")), F.lit("unknown"))
    counts = cleaned.filter("filtered").groupBy(reason.alias("filter_reason")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "filter_reason")


def bucket_of(df: DataFrame) -> Column:
    """The stored bucket, or the one that follows from the score."""
    computed = X.quality_bucket(F.coalesce("quality_score", F.lit(0.0)))
    return F.coalesce(F.nullif(F.col("quality_bucket"), F.lit("")), computed) if "quality_bucket" in df.columns else computed


def quality_distribution(df: DataFrame) -> DataFrame:
    """quality_bucket, count, in the order high, medium, low, with zeros."""
    counts = df.agg(*[F.count_if(bucket_of(df) == name).alias(name) for _, name in P.QUALITY_BUCKETS])
    rows = F.array(*[F.struct(F.lit(n).alias("quality_bucket"), F.col(n).alias("count")) for _, n in P.QUALITY_BUCKETS])
    return counts.select(F.inline(rows))


def safety_flag_counts(cleaned: DataFrame) -> DataFrame:
    """safety_flag, count; most frequent first."""
    counts = cleaned.select(F.explode("safety_flags").alias("safety_flag")).groupBy("safety_flag").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "safety_flag")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("count"))


def best_rows(sampled: DataFrame, n: int = 3) -> DataFrame:
    return sampled.orderBy(F.desc("quality_score"), "train_rank").limit(n)


def top_samples(sampled: DataFrame, n: int = 3) -> DataFrame:
    """The best sampled rows with a preview; ties in training order."""
    return best_rows(sampled, n).select("train_rank", "source", "quality_score", X.preview("text").alias("preview"))


def filtered_samples(cleaned: DataFrame, n: int = 5) -> DataFrame:
    """The first filtered rows in input order with a preview."""
    first = cleaned.filter("filtered").select("ord", "filter_reason", "source", "text").orderBy("ord").limit(n)
    return first.select("ord", "filter_reason", "source", X.preview("text").alias("preview"))


def report_core(
    sampled: DataFrame,
    cleaned: DataFrame | None = None,
    raw_records: int | None = None,
    dedup: dict | None = None,
    total_tokens: int | None = None,
    filtered_records: int | None = None,
) -> DataFrame:
    """One row with the headline figures; what the caller does not know is derived from the frames."""
    train = sampled.agg(F.count("*").alias("train_records"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("train_tokens"))
    if cleaned is None:
        seen = train.select(F.col("train_records").alias("all_records"), F.lit(0).cast("bigint").alias("filtered_records"))
    else:
        seen = cleaned.agg(F.count("*").alias("all_records"), F.count_if(F.col("filtered")).alias("filtered_records"))
    row = train.join(seen)  # two one-row frames

    def known(value, fallback: Column) -> Column:
        return fallback if value is None else F.lit(value).cast("bigint")

    dedup = dedup or {}
    row = row.withColumn("raw_records", known(raw_records, F.col("all_records")))
    row = row.withColumn("filtered_records", known(filtered_records, F.col("filtered_records")))
    row = row.withColumn("kept_records", F.col("raw_records") - F.col("filtered_records"))
    row = row.withColumn("dedup_before", known(dedup.get("input_records"), F.col("kept_records")))
    row = row.withColumn("dedup_after", known(dedup.get("output_records"), F.col("train_records")))
    return row.select(
        "raw_records",
        "kept_records",
        "filtered_records",
        "dedup_before",
        "dedup_after",
        X.ratio(F.col("dedup_before") - F.col("dedup_after"), F.col("dedup_before")).alias("duplicate_rate"),
        "train_records",
        known(total_tokens, F.col("train_tokens")).alias("total_tokens"),
    )
