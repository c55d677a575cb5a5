"""Cleaning: normalise the text, classify it, flag private data, and decide what to filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chars as C
from corpusloom.functions import text as X
from corpusloom.functions.frames import once, ship_package
from corpusloom.operators.schema import CANONICAL, normalize_records
from corpusloom.plans.config import CleanConfig

VERDICT_COUNTERS = ["length", "visible", "alnum", "distinct", "urls", "max_run"]
COUNTERS = ["length", "visible", "zh", "letters", "digits", "symbols", "alnum", "distinct", "keywords", "urls", "max_run"]


def with_counters(df: DataFrame, names: list[str] = COUNTERS, text: str = "text") -> DataFrame:
    """Add a struct ``counters`` of character statistics, each computed once."""
    df = ship_package(df).withColumn("_chars", C.char_counts(text, C.classes_of(df.sparkSession)))
    every: dict[str, Column] = {
        "length": F.length(text).cast("bigint"),
        **{n: F.col(f"_chars.{n}") for n in C.CHAR_COUNTERS},
        "max_run": F.coalesce("_chars.max_run", F.lit(1)),
        "urls": X.url_count(text),
    }
    return once(df, counters=F.struct(*[every[n].alias(n) for n in names])).drop("_chars")


def language_of(counters: str = "counters") -> Column:
    c = {n: F.col(f"{counters}.{n}") for n in ("visible", "zh", "letters", "digits", "symbols", "keywords")}
    return X.detect_language(**c)


def filter_reason(flags: Column, config: CleanConfig, counters: str = "counters") -> Column:
    """Why a text is filtered, '' if it is not; the first matching rule wins."""
    c = {n: F.col(f"{counters}.{n}") for n in VERDICT_COUNTERS}
    low_information = (X.ratio(c["alnum"], c["visible"]) < config.min_info_ratio) | (
        X.ratio(c["distinct"], c["visible"]) < config.min_unique_ratio
    )
    reason = (
        F.when(c["visible"] == 0, "empty_text")
        .when(c["length"] < config.min_chars, "too_short")
        .when(c["length"] > config.max_chars, "too_long")
        .when(c["urls"] > config.max_urls, "too_many_urls")
        .when(c["max_run"] >= config.repeated_char_threshold, "repeated_chars")
    )
    if config.enable_pii_filter:
        reason = reason.when(F.size(flags) > 0, "pii_detected")
    return reason.when(low_information, "low_information").otherwise("")


def clean(df: DataFrame, config: CleanConfig = CleanConfig(), keep_counters: bool = False, canonical: bool = False) -> DataFrame:
    """Canonical rows with normalised text, language, safety flags and the filter verdict.

    Purely row by row: no shuffle, and usable on a stream.  ``canonical`` says that the rows have been
    through ``normalize_records`` already.
    """
    df = once(df if canonical else normalize_records(df), text=X.normalize_text("text"))
    df = with_counters(df)
    df = once(
        df,
        _pii=X.pii_flags("text"),
        language=F.when(F.col("source") == "code", "code").otherwise(language_of()),
    )
    df = once(
        df,
        filter_reason=filter_reason(F.col("_pii"), config),
        safety_flags=F.array_distinct(F.concat("safety_flags", "_pii")),
    )
    df = df.withColumn("filtered", F.col("filter_reason") != "")
    extra = [c for c in df.columns if c not in CANONICAL.names and c != "_pii" and (keep_counters or c != "counters")]
    return df.select(*extra, *CANONICAL.names)


def measured(df: DataFrame, keep: list[str] = []) -> DataFrame:
    """Canonical rows' normalised texts (if kept) with all that a verdict needs, whatever its limits are."""
    df = once(df.select(*{"text": None, **dict.fromkeys(keep)}), text=X.normalize_text("text"))
    df = with_counters(df, VERDICT_COUNTERS)
    return once(df, _pii=X.pii_flags("text")).select(*keep, "counters", "_pii")


def verdict(config: CleanConfig = CleanConfig()) -> Column:
    """The filter reason of a :func:`measured` row."""
    return filter_reason(F.col("_pii"), config)


def verdicts(df: DataFrame, config: CleanConfig = CleanConfig(), keep: list[str] = []) -> DataFrame:
    """(filter_reason, filtered) of canonical rows, after the columns to keep: only the counters that the verdict needs."""
    df = once(measured(df, keep), filter_reason=verdict(config))
    return df.select(*keep, "filter_reason", (F.col("filter_reason") != "").alias("filtered"))


def keep_unfiltered(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("filtered"))


def cleaning_stats(cleaned: DataFrame) -> DataFrame:
    """One row: input, kept and filtered records."""
    return cleaned.agg(
        F.count("*").alias("input_records"),
        F.count_if(~F.col("filtered")).alias("kept_records"),
        F.count_if(F.col("filtered")).alias("filtered_records"),
    )


def filter_reason_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter("filtered").groupBy("filter_reason").agg(F.count("*").alias("records"))
