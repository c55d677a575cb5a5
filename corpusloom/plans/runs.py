"""The jobs a user calls: the full run, cleaning only, and a report of an existing training set."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import patterns as P
from corpusloom.functions import text as X
from corpusloom.functions.frames import materialize, once, own_scratch
from corpusloom.functions.text import hash_form, quality_bucket
from corpusloom.operators import cleaning, report
from corpusloom.operators.dedup import dedup_rollup, exact_dedup
from corpusloom.operators.neardup import near_dedup
from corpusloom.operators.quality import add_quality_scores
from corpusloom.operators.sampling import sample_by_quality, sample_by_source_ratio
from corpusloom.operators.tokens import Tokenizer, add_token_counts
from corpusloom.plans.config import RunConfig
from corpusloom.sources import sinks
from corpusloom.sources.jsonl import count_records, load_corpus, read_train


def _values(df: DataFrame) -> dict[str, Any]:
    return df.first().asDict()


def _counts(df: DataFrame) -> dict[str, int]:
    """A small (name, count) table as a dict."""
    return {str(k): v for k, v in df.collect()}


def row_pass(records: DataFrame, config: RunConfig, tokenizer: Tokenizer = Tokenizer()) -> DataFrame:
    """All row-level work in one pass over the texts: cleaning, signature, tokens, score.

    Nothing of it depends on other rows, so the stages after this one only move narrow columns.  The
    columns of later stages are prepared under names with a leading underscore.
    """
    rows = cleaning.clean(records, config.cleaning, keep_counters=True, canonical=True)
    rows = once(rows, _signature=F.md5(hash_form("text")))
    later = add_quality_scores(add_token_counts(rows, tokenizer), flags_complete=True)
    prepared = later.select(
        *[c for c in records.columns if c not in ("token_count", "quality_score", "metadata")],
        "_signature",
        F.col("token_count").alias("_token_count"),
        F.col("quality_score").alias("_quality_score"),
        F.lit(0).cast("bigint").alias("token_count"),
        F.lit(0.0).alias("quality_score"),
        F.map_filter("metadata", lambda k, _: k != "quality_bucket").alias("metadata"),
    )
    return prepared


def scored(rows: DataFrame) -> DataFrame:
    """Put the prepared columns in place."""
    bucket = quality_bucket("quality_score")
    rows = rows.drop("token_count", "quality_score", "dedup_signature").withColumnsRenamed(
        {"_token_count": "token_count", "_quality_score": "quality_score", "_signature": "dedup_signature"}
    )
    return rows.withColumns(
        {"quality_bucket": bucket, "metadata": F.map_concat("metadata", F.create_map(F.lit("quality_bucket"), bucket))}
    )


def deduplicate(kept: DataFrame, config: RunConfig) -> tuple[DataFrame, dict[str, Any]]:
    """Exact, then near deduplication of prepared rows; returns the surviving rows and what the stages did, by name."""
    rows, stages = kept, {}
    if config.dedup.exact:
        stages["exact"] = exact_dedup(rows.withColumn("dedup_signature", F.col("_signature")), prepared=True)
        rows = stages["exact"].kept
    if config.dedup.approximate:
        stages["approximate"] = near_dedup(rows, config.dedup.approximate_threshold, config.dedup.ngram_size, config.dedup.method)
        rows = stages["approximate"].kept
    return rows, stages


def _dedup_metrics(kept: DataFrame, stages: dict[str, Any]) -> dict[str, Any]:
    details = {name: _values(stage.stats) for name, stage in stages.items()}
    if details:
        totals = list(details.values())
        before, after = totals[0]["input_records"], totals[-1]["output_records"]
    else:
        before = after = kept.count()
    return {**dedup_rollup(before, after), **details}


def train_set(records: DataFrame, config: RunConfig, tokenizer: Tokenizer = Tokenizer()) -> DataFrame:
    """The sampled training rows (with ``ord`` and ``train_rank``) as a DataFrame, without writing outputs."""
    rows = materialize(row_pass(records, config, tokenizer), "rows")
    kept, _ = deduplicate(cleaning.keep_unfiltered(rows), config)
    candidates = sample_by_quality(scored(kept), config.min_score)
    return sample_by_source_ratio(candidates, config.sampling.source_ratios, config.sampling.max_records)


# Values that counts are kept for while a table is written; all that canonical rows can hold.
SOURCES = sorted({*P.VALID_SOURCES, "unknown"})


def _by(name: str, values: list[str], condition: Callable[[str], Column], what: Callable[[Column], Column] = F.count_if) -> Column:
    """An aggregate that counts (or adds up) for each of the values, as a struct."""
    return F.struct(*[what(condition(v)).alias(v) for v in values]).alias(name)


def _positive(counts: Row) -> dict[str, int]:
    return {name: n for name, n in counts.asDict().items() if n}


def _written(df: DataFrame, path: str, partition: str, aggregates: list[Column], mode: str) -> dict[str, Any]:
    """Write a table and return aggregates over it, which are taken while it is written."""
    seen = Observation()
    sinks.write_corpus(df.observe(seen, *aggregates), path, partition, mode)
    return seen.get


class Stages:
    """What a run has finished: a note per stage, which a later run with the same key goes on from.

    A stage's outputs count only once its note is there, and the note is written last; what an interrupted stage left is written anew.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, resume: bool, mode: str):
        self.spark, self.folder, self.key, self.resume = spark, folder, key, resume
        self.mode = "overwrite" if resume else mode

    def done(self, name: str) -> dict[str, Any] | None:
        if not self.resume:
            return None
        try:
            note = json.loads("\n".join(r.value for r in self.spark.read.text(f"{self.folder}/{name}").collect()))
        except AnalysisException:  # no such folder
            return None
        return note["result"] if note["key"] == self.key else None

    def finish(self, name: str, result: dict[str, Any]) -> dict[str, Any]:
        text = json.dumps({"key": self.key, "result": result}, ensure_ascii=False)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}")
        return json.loads(text)["result"]


def _run_key(spark: SparkSession, input_path: str, pattern: str, config: RunConfig, tokenizer: Tokenizer) -> str:
    """Changes with the settings and with the input files' names, sizes and times; their content isn't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(input_path).select("path", "length", "modificationTime")
    listing = files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime")))).first()
    return hashlib.sha256(repr((tuple(listing), config, tokenizer.name, tokenizer.error)).encode()).hexdigest()


def _clean_stage(spark: SparkSession, input_path: str, pattern: str, config: RunConfig, tokenizer: Tokenizer, path: str, mode: str) -> dict[str, Any]:
    """Write the interim rows; returns their schema and counts."""
    blocks = materialize(count_records(spark, input_path, pattern=pattern), "blocks")
    if not blocks.agg(F.sum("records")).first()[0]:
        raise FileNotFoundError(f"no JSONL records in {input_path}")
    rows = row_pass(load_corpus(spark, input_path, pattern=pattern, blocks=blocks), config, tokenizer)
    seen = _written(rows, path, "filtered", [
        F.count("*").alias("records"),
        _by("sources", SOURCES, lambda v: F.col("source") == v),
        _by("reasons", P.FILTER_REASONS, lambda v: F.col("filter_reason") == v),
        _by("flags", P.PII_FLAGS, lambda v: F.array_contains("safety_flags", v)),
    ], mode)
    reasons = _positive(seen["reasons"])
    return {
        "schema": rows.schema.json(), "sources": _positive(seen["sources"]), "reasons": reasons, "flags": _positive(seen["flags"]),
        "records": seen["records"], "filtered": sum(reasons.values()),
    }


def _processed_stage(spark: SparkSession, cleaned: DataFrame, config: RunConfig, paths: dict[str, str], mode: str) -> dict[str, Any]:
    """Write the duplicate lists and the processed rows; returns what the stages did and the processed rows' totals."""
    kept = cleaning.keep_unfiltered(cleaned)
    survivors, stages = deduplicate(kept, config)
    dedup = _dedup_metrics(kept, stages)
    # The duplicates themselves, in input order: what was removed and for which record.
    if exact := stages.get("exact"):
        sinks.write_jsonl(exact.duplicates, paths["duplicate_ids"], "ord", mode)
    if near := stages.get("approximate"):
        sinks.write_jsonl(near.pairs, paths["duplicate_pairs"], "ord", mode)
    survivors = scored(survivors)
    buckets = [name for _, name in P.QUALITY_BUCKETS]
    lengths = [name for _, name in P.LENGTH_BUCKETS]
    tokens, score = F.col("token_count"), F.col("quality_score")
    seen = _written(survivors, paths["processed"], "source", [
        F.count("*").alias("records"),
        *[f("token_count").alias(f"tokens_{name}") for name, f in (("sum", F.sum), ("min", F.min), ("max", F.max))],
        # Scores have four digits, so their sum in units of the last is exact and doesn't depend on the order of rows.
        F.sum(F.round(score * 10_000).cast("bigint")).alias("score_sum"), F.min(score).alias("score_min"), F.max(score).alias("score_max"),
        _by("source_tokens", SOURCES, lambda v: F.when(F.col("source") == v, tokens), F.sum),
        _by("lengths", lengths, lambda v: X.length_bucket("token_count") == v),
        *[_by(f"buckets_{b}", SOURCES, lambda v, b=b: (F.col("source") == v) & (F.col("quality_bucket") == b)) for b in buckets],
    ], mode)
    n = seen["records"]
    by_bucket = {b: _positive(seen[f"buckets_{b}"]) for b in buckets}
    return {
        "schema": survivors.schema.json(),
        "dedup": dedup,
        "tokens": {
            "total_tokens": seen["tokens_sum"] or 0, "avg_tokens": round((seen["tokens_sum"] or 0) / n, 2) if n else 0.0,
            "min_tokens": seen["tokens_min"] or 0, "max_tokens": seen["tokens_max"] or 0,
            "token_count_by_source": {s: t for s, t in seen["source_tokens"].asDict().items() if t is not None},
            "length_distribution": _positive(seen["lengths"]),
        },
        "quality": {
            "quality_summary": {
                "avg_score": round((seen["score_sum"] or 0) / 10_000 / n, 4) if n else 0.0,
                "min_score": seen["score_min"] or 0.0, "max_score": seen["score_max"] or 0.0,
            },
            "quality_distribution": {b: sum(counts.values()) for b, counts in by_bucket.items() if counts},
            "quality_by_source_bucket": {f"{s}:{b}": k for b, counts in by_bucket.items() for s, k in counts.items()},
        },
    }


def run(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    config: RunConfig = RunConfig(),
    tokenizer: Tokenizer = Tokenizer(),
    mode: str = "errorifexists",
    pattern: str = "*.jsonl",
    resume: bool = False,
) -> dict[str, str]:
    """Raw JSONL to a training set with report tables; returns the output folders.

    The interim, processed and training outputs are written once each and read back where a later stage
    needs them, so a lost executor costs a part of one stage at most; counts are taken while a table is written.  With ``resume`` a run
    goes on behind the last stage that an earlier one with the same settings and input files finished in this folder.
    """
    out = output_dir.rstrip("/")
    paths = {n: f"{out}/{n}" for n in ("clean", "processed", "train", "metrics", "source_distribution", "filtered_reasons",
                                       "quality_distribution", "safety_flags", "core", "top_samples", "filtered_samples",
                                       "duplicate_ids", "duplicate_pairs")}
    with own_scratch(spark):
        _run(spark, input_path, f"{out}/_stages", paths, config, tokenizer.checked(spark), mode, pattern, resume)
    return paths


def _run(
    spark: SparkSession, input_path: str, notes: str, paths: dict[str, str], config: RunConfig, tokenizer: Tokenizer, mode: str, pattern: str, resume: bool
) -> None:
    stages = Stages(spark, notes, _run_key(spark, input_path, pattern, config, tokenizer), resume, mode)

    # Interim: cleaned rows in Parquet, kept and filtered apart, with the prepared columns.
    clean = stages.done("clean") or stages.finish("clean", _clean_stage(spark, input_path, pattern, config, tokenizer, paths["clean"], stages.mode))
    cleaned = spark.read.schema(T.StructType.fromJson(json.loads(clean["schema"]))).parquet(paths["clean"])
    processed = stages.done("processed") or stages.finish("processed", _processed_stage(spark, cleaned, config, paths, stages.mode))
    metrics: dict[str, Any] = {
        "project": {"name": config.project},
        "ingest": {"raw_records": clean["records"], "records_by_source": clean["sources"]},
        "cleaning": {
            "input_records": clean["records"], "kept_records": clean["records"] - clean["filtered"], "filtered_records": clean["filtered"],
            "filter_reasons": clean["reasons"],
        },
        "dedup": processed["dedup"],
        "tokenizer": {"tokenizer": tokenizer.name, "tokenizer_error": tokenizer.error, **processed["tokens"]},
        "quality": processed["quality"],
    }
    if (sampling := stages.done("train")) is None:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(processed["schema"]))).parquet(paths["processed"])
        candidates = sample_by_quality(rows, config.min_score)
        sampled = materialize(sample_by_source_ratio(candidates, config.sampling.source_ratios, config.sampling.max_records), "sampled")
        sinks.export_train(sampled, paths["train"], mode=stages.mode)
        sampling = stages.finish("train", {"quality_candidates": candidates.count(), "train_records": sampled.count()})
    metrics["sampling"] = {
        **sampling, "max_records": config.sampling.max_records, "source_ratios": config.sampling.source_ratios, "train_path": paths["train"],
    }
    train = read_train(spark, paths["train"])
    core = report.report_core(train, None, clean["records"], processed["dedup"], processed["tokens"]["total_tokens"], clean["filtered"])
    _write_report(spark, train, core, metrics, paths, stages.mode, clean["reasons"], clean["flags"], cleaned)


def _write_report(
    spark: SparkSession, sampled: DataFrame, core: DataFrame, metrics: dict, paths: dict, mode: str,
    reasons: dict[str, int] = {}, flags: dict[str, int] = {}, cleaned: DataFrame | None = None,
) -> None:
    by_source = report.source_distribution(sampled)
    buckets = report.quality_distribution(sampled)
    sinks.write_csv(by_source, paths["source_distribution"], ["source", "record_count", "token_count", "token_share"], mode)
    sinks.write_csv(buckets, paths["quality_distribution"], ["quality_bucket", "count"], mode)
    for counts, name, column in ((reasons, "filtered_reasons", "filter_reason"), (flags, "safety_flags", "safety_flag")):
        table = spark.createDataFrame(sorted(counts.items(), key=lambda x: (-x[1], x[0])), f"{column} string, count bigint")
        sinks.write_csv(table, paths[name], [column, "count"], mode)
    if cleaned is not None:
        sinks.write_csv(report.filtered_samples(cleaned), paths["filtered_samples"], ["filter_reason", "source", "preview"], mode)
    sinks.write_csv(report.top_samples(sampled), paths["top_samples"], ["source", "quality_score", "preview"], mode)
    sinks.write_csv(core, paths["core"], core.columns, mode)
    sources = by_source.collect()  # at most one row per source
    metrics["core"] = _values(core)
    metrics["tables"] = {
        "source_counts": {r.source: r.record_count for r in sources},
        "source_tokens": {r.source: r.token_count for r in sources},
        "quality_distribution": {name: n for name, n in _counts(buckets).items() if n},
        "filtered_reasons": reasons,
        "safety_flags": flags,
    }
    sinks.write_metrics(spark, metrics, paths["metrics"], mode)


def run_clean(
    spark: SparkSession, input_path: str, output_path: str, config: RunConfig = RunConfig(), mode: str = "errorifexists", pattern: str = "*.jsonl"
) -> str:
    """Load, parse and clean only; JSON lines in input order."""
    with own_scratch(spark):
        # Written once: bringing the rows into order reads its input twice.
        rows = materialize(cleaning.clean(load_corpus(spark, input_path, pattern=pattern), config.cleaning, canonical=True), "clean")
        sinks.write_jsonl(rows, output_path, "ord", mode)
    return output_path


def run_report(spark: SparkSession, input_path: str, output_dir: str, mode: str = "errorifexists") -> dict[str, str]:
    """Report tables of an exported training set; buckets follow from the scores."""
    out = output_dir.rstrip("/")
    names = ("metrics", "source_distribution", "filtered_reasons", "quality_distribution", "safety_flags", "core", "top_samples")
    paths = {n: f"{out}/{n}" for n in names}
    train = read_train(spark, input_path)
    _write_report(spark, train, report.report_core(train), {}, paths, mode)
    return paths
