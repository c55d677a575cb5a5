"""Rule-based quality features, scores and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.frames import once
from corpusloom.functions.rounding import python_round
from corpusloom.operators.cleaning import with_counters


def extract_features(df: DataFrame, flags_complete: bool = False) -> DataFrame:
    """Add a struct ``features``.  ``flags_complete``: ``safety_flags`` already covers this text."""
    own = "counters" not in df.columns
    if own:
        df = with_counters(df, ["length", "visible", "symbols", "alnum", "urls", "max_run"])
    flagged = F.size("safety_flags") > 0
    if not flags_complete:
        flagged = F.when(flagged, True).otherwise(F.size(X.pii_flags("text")) > 0)
    structured = F.contains(F.col("text"), F.lit("Instruction:")) & F.contains(F.col("text"), F.lit("Output:"))
    df = once(
        df,
        features=F.struct(
            F.coalesce("token_count", F.lit(0)).cast("bigint").alias("token_count"),
            F.col("counters.length").alias("text_length"),
            F.col("counters.urls").alias("url_count"),
            X.ratio("counters.max_run", "counters.length").alias("repeat_char_ratio"),
            flagged.alias("pii_flag"),
            F.coalesce("language", F.lit("unknown")).alias("language"),
            F.coalesce("source", F.lit("unknown")).alias("source"),
            X.ratio("counters.symbols", "counters.visible").alias("code_symbol_ratio"),
            X.ratio("counters.alnum", "counters.visible").alias("alpha_digit_ratio"),
            structured.alias("has_instruction_structure"),
        ),
    )
    return df.drop("counters") if own else df


def _steps(value: Column, *steps: tuple[Column, float]) -> Column:
    """The change of the first step whose condition holds, else 0.0."""
    out = F
    for condition, change in steps:
        out = out.when(condition, F.lit(change))
    return value + out.otherwise(F.lit(0.0))


def quality_score(features: str = "features") -> Column:
    """Score in [0, 1] from additive rules, rounded to 4 digits.

    The weights are fixed values, and so is the order in which they are added (it decides the last bits).
    """
    f = {n: F.col(f"{features}.{n}") for n in (
        "token_count", "url_count", "repeat_char_ratio", "pii_flag", "language", "source",
        "code_symbol_ratio", "alpha_digit_ratio", "has_instruction_structure",
    )}
    code = f["source"] == "code"
    score = F.lit(1.0)
    score = _steps(score, (f["token_count"] <= 0, -0.6), (f["token_count"] < 15, -0.3), (f["token_count"] < 32, -0.12))
    score = _steps(score, (f["url_count"] > 10, -0.35), (f["url_count"] > 3, -0.15))
    score = _steps(score, (f["repeat_char_ratio"] > 0.25, -0.35), (f["repeat_char_ratio"] > 0.12, -0.15))
    score = _steps(score, (f["pii_flag"], -0.55))
    score = _steps(score, (f["language"] == "unknown", -0.15))
    score = _steps(score, (code & (f["code_symbol_ratio"] > 0.55), -0.1))
    score = _steps(score, (~code & (f["code_symbol_ratio"] > 0.3), -0.18))
    score = _steps(score, (~code & (f["alpha_digit_ratio"] < 0.35), -0.18))
    instruction = f["source"] == "instruction"
    score = _steps(score, (instruction & f["has_instruction_structure"], 0.08), (instruction, -0.12))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4)


def add_quality_scores(df: DataFrame, flags_complete: bool = False) -> DataFrame:
    """Set ``quality_score`` and ``quality_bucket``, and copy the bucket into the metadata."""
    df = extract_features(df, flags_complete)
    df = once(df, quality_score=quality_score()).drop("features")
    bucket = X.quality_bucket("quality_score")
    others = F.map_filter("metadata", lambda k, _: k != "quality_bucket")
    return df.withColumns(
        {"quality_bucket": bucket, "metadata": F.map_concat(others, F.create_map(F.lit("quality_bucket"), bucket))}
    )


def quality_stats(df: DataFrame) -> DataFrame:
    """One row: average, sum (in ten-thousandths), minimum and maximum score; zeros for an empty input."""
    score = F.col("quality_score")
    # Scores have four digits, so their sum in units of the last is exact and doesn't depend on the order of rows.
    total = F.coalesce(F.sum(F.round(score * 10_000).cast("bigint")), F.lit(0))
    totals = df.agg(
        F.coalesce(total / 10_000 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("avg_score"),
        total.alias("score_sum"),
        F.coalesce(F.min(score), F.lit(0.0)).alias("min_score"),
        F.coalesce(F.max(score), F.lit(0.0)).alias("max_score"),
    )
    return totals.withColumn("avg_score", python_round(F.col("avg_score"), 4))


def quality_counts(df: DataFrame) -> DataFrame:
    """Records by bucket (``source`` is NULL) and by source and bucket, from one pass."""
    return (
        df.groupingSets([["quality_bucket"], ["source", "quality_bucket"]], "source", "quality_bucket")
        .agg(F.grouping("source").alias("_all"), F.count("*").alias("records"))
        .select(F.when(F.col("_all") == 1, F.lit(None)).otherwise(F.col("source")).alias("source"), "quality_bucket", "records")
    )
