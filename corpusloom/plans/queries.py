"""One query per operator over the corpus tables; each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.frames import materialize, once, scratch_dir, ship_package, shuffles_go
from corpusloom.operators import cleaning, dedup, hamming, neardup, quality, report, sampling, schema, tokens
from corpusloom.plans import runs
from corpusloom.plans.config import CleanConfig, RunConfig, SamplingConfig
from corpusloom.sources import jsonl, raw, tables

Query = Callable[[SparkSession, str], DataFrame]

RATIOS = {"web": 0.35, "document": 0.25, "code": 0.20, "instruction": 0.20}
# Long texts have few distinct characters for their length; without that rule more rows reach the later stages.
LONG_TEXTS = CleanConfig(min_unique_ratio=0.0)
CONFIG = RunConfig(cleaning=LONG_TEXTS, sampling=SamplingConfig(max_records=300, source_ratios=RATIOS))


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) with normalised text."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text"], "doc_id")
    return once(d, text=X.normalize_text("text"))


def raw_docs(spark: SparkSession, folder: str) -> DataFrame:
    """(ord, id, text) as given."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text"], "doc_id")
    return d.select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), "text")


def cleaned_docs(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(tables.load_tables(spark, folder, ("document",)), canonical=True)


def scored_corpus(spark: SparkSession, folder: str, config: CleanConfig = LONG_TEXTS) -> DataFrame:
    """All tables, cleaned, counted and scored."""
    rows = cleaning.clean(tables.load_tables(spark, folder), config, keep_counters=True, canonical=True)
    return quality.add_quality_scores(tokens.add_token_counts(rows), flags_complete=True).drop("counters")


def narrow_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The scored corpus without texts, written once because sampling reads it several times."""
    rows = scored_corpus(spark, folder)
    return materialize(rows.select("ord", "id", "source", "filtered", "quality_score", "token_count"), "scored")


# --- cleaning ---------------------------------------------------------------------------------------


def normalize_text(spark, folder):
    return docs(spark, folder)


def text_counters(spark, folder):
    return cleaning.with_counters(docs(spark, folder)).select("doc_id", "counters.*")


def detect_language(spark, folder):
    c = cleaning.with_counters(docs(spark, folder), ["visible", "zh", "letters", "digits", "symbols", "keywords"])
    return c.select("doc_id", cleaning.language_of().alias("language"))


def pii_flags(spark, folder):
    return docs(spark, folder).select("doc_id", F.concat_ws(",", X.pii_flags("text")).alias("flags"))


def filter_reason(spark, folder):
    return cleaned_docs(spark, folder).select("id", "filtered", "filter_reason")


def clean_records(spark, folder):
    c = cleaning.clean(tables.load_tables(spark, folder), canonical=True)
    flags = F.concat_ws(",", "safety_flags").alias("flags")
    return c.select("ord", "id", "source", "language", "domain", flags, "filter_reason", "text")


def clean_stats(spark, folder):
    return cleaning.cleaning_stats(cleaning.verdicts(tables.load_tables(spark, folder, ("document",))))


def clean_filter_reasons(spark, folder):
    return cleaning.filter_reason_counts(cleaning.verdicts(tables.load_tables(spark, folder, ("document",))))


def repeated_run(spark, folder):
    return docs(spark, folder).select("doc_id", X.max_run("text").alias("max_run"))


def info_unique_ratio(spark, folder):
    c = cleaning.with_counters(docs(spark, folder), ["visible", "alnum", "distinct"])
    info, unique = X.ratio("counters.alnum", "counters.visible"), X.ratio("counters.distinct", "counters.visible")
    return c.select("doc_id", F.round(info, 6).alias("info_ratio"), F.round(unique, 6).alias("unique_ratio"))


def ingest_counts(spark, folder):
    return tables.load_tables(spark, folder).groupBy("source").agg(F.count("*").alias("records"))


# --- deduplication ----------------------------------------------------------------------------------


def exact_dedup(spark, folder):
    return dedup.exact_dedup(raw_docs(spark, folder)).kept.select("ord", "dedup_signature")


def exact_dedup_stats(spark, folder):
    return dedup.exact_dedup(raw_docs(spark, folder)).stats


def exact_duplicates(spark, folder):
    return dedup.exact_dedup(raw_docs(spark, folder)).duplicates


def sha1_sig(spark, folder):
    return raw_docs(spark, folder).select("ord", F.sha1(X.hash_form("text")).alias("sha1"))


def char_ngrams(spark, folder):
    grams = ship_package(raw_docs(spark, folder)).select("ord", X.char_ngrams_digest("text").alias("digest"))
    return grams.select("ord", "digest.grams", "digest.grams_md5")


def turn_jaccard(spark, folder):
    pairs = tables.turn_pairs(spark, folder)
    sets = once(pairs, a=X.char_ngrams("question"), b=X.char_ngrams("answer"))
    return sets.select("conv_id", "turn", F.round(X.jaccard("a", "b"), 6).alias("similarity"))


def near_dedup(spark, folder):
    kept = dedup.exact_dedup(raw_docs(spark, folder)).kept
    return neardup.near_dedup(kept).pairs


def near_dedup_50(spark, folder):
    """A low threshold, over the default index."""
    return neardup.near_dedup(dedup.exact_dedup(raw_docs(spark, folder)).kept, threshold=0.5).pairs


def near_dedup_70(spark, folder):
    return neardup.near_dedup(dedup.exact_dedup(raw_docs(spark, folder)).kept, threshold=0.7).pairs


def near_dedup_rare(spark, folder):
    """The default threshold over the index of rare members."""
    return neardup.near_dedup(dedup.exact_dedup(raw_docs(spark, folder)).kept, index="rare").pairs


def minhash_near_dedup_70(spark, folder):
    return neardup.near_dedup(dedup.exact_dedup(raw_docs(spark, folder)).kept, threshold=0.7, method="minhash").pairs


def near_dedup_kept(spark, folder):
    return neardup.near_dedup(raw_docs(spark, folder)).kept.select("ord", F.md5("text").alias("text_md5"))


def near_dedup_stats(spark, folder):
    return neardup.near_dedup(dedup.exact_dedup(raw_docs(spark, folder)).kept).stats


def minhash_near_dedup(spark, folder):
    kept = dedup.exact_dedup(raw_docs(spark, folder)).kept
    return neardup.near_dedup(kept, method="minhash").pairs


def dedup_rollup(spark, folder):
    exact = dedup.exact_dedup(raw_docs(spark, folder))
    near = neardup.near_dedup(exact.kept)
    counts = exact.first.agg(F.sum("copies").alias("input_records"), F.count("*").alias("_distinct"))
    counts = counts.join(near.dropped.agg(F.count("*").alias("_near")))  # two one-row frames
    counts = counts.withColumn("output_records", F.col("_distinct") - F.col("_near"))
    removed = F.col("input_records") - F.col("output_records")
    rate = F.round(X.ratio(removed, "input_records"), 6)
    return counts.select("input_records", "output_records", removed.alias("duplicates_removed"), rate.alias("duplicate_rate"))


def simhash_sig(spark, folder):
    return dedup.simhash_signatures(raw_docs(spark, folder), "ord")


def hamming_pairs(spark, folder):
    """Pairs of different SimHash signatures of the documents in up to 3 bits."""
    return hamming.hamming_pairs(dedup.simhash_signatures(raw_docs(spark, folder), "ord"), max_distance=3)


def turn_hamming(spark, folder):
    pairs = tables.turn_pairs(spark, folder)
    sides = pairs.select(F.struct("conv_id", "turn", F.lit("q").alias("side")).alias("key"), F.col("question").alias("text")).union(
        pairs.select(F.struct("conv_id", "turn", F.lit("a").alias("side")), "answer")
    )
    hashes = dedup.simhash_signatures(sides, "key").select("key.*", "simhash")
    both = hashes.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("side") == "q", F.col("simhash"))).alias("q"), F.max(F.when(F.col("side") == "a", F.col("simhash"))).alias("a")
    )
    return both.select("conv_id", "turn", X.hamming("q", "a").cast("bigint").alias("distance"))


# --- tokens -----------------------------------------------------------------------------------------


def tokenize(spark, folder):
    found = docs(spark, folder).select(F.explode(X.tokens("text")).alias("token"))
    return found.groupBy("token").agg(F.count("*").alias("occurrences"))


def tokenize_count(spark, folder):
    n = tokens.add_token_counts(docs(spark, folder))
    return n.select("doc_id", "token_count", X.length_bucket("token_count").alias("length_bucket"))


def counted_docs(spark, folder):
    return tokens.add_token_counts(tables.load_tables(spark, folder, ("document",)))


def token_stats(spark, folder):
    return tokens.token_stats(counted_docs(spark, folder))


def length_distribution(spark, folder):
    return tokens.length_distribution(counted_docs(spark, folder))


def tokens_by_source(spark, folder):
    return tokens.tokens_by_source(tokens.add_token_counts(tables.load_tables(spark, folder)))


class CharacterTokenizer:
    """A pluggable tokenizer: every visible character is a token."""

    def tokenize(self, text: str) -> list[str]:
        return [c for c in text if not c.isspace()]


def pluggable_tokenizer(spark, folder):
    tokenizer = tokens.Tokenizer("characters", CharacterTokenizer).checked(spark)
    return tokens.add_token_counts(docs(spark, folder), tokenizer).select("doc_id", "token_count")


def absent_on_workers():
    """A loader whose vocabulary lies on the driver alone."""
    if TaskContext.get() is not None:
        raise FileNotFoundError("no vocabulary on this machine")
    return CharacterTokenizer()


def tokenizer_fallback(spark, folder):
    """A tokenizer that fails on the workers: the built-in rule counts, and the error is told."""
    tokenizer = tokens.Tokenizer("absent", absent_on_workers).checked(spark)
    counted = tokens.add_token_counts(docs(spark, folder), tokenizer)
    return counted.select("doc_id", "token_count", F.lit(tokenizer.name).alias("tokenizer"), F.lit(tokenizer.error).alias("error"))


# --- quality ----------------------------------------------------------------------------------------


def quality_features(spark, folder):
    # The texts are counted and searched for personal data once, while they are cleaned.
    rows = cleaning.clean(tables.load_tables(spark, folder, ("document",)), keep_counters=True, canonical=True)
    f = quality.extract_features(tokens.add_token_counts(rows), flags_complete=True).select("id", "features.*")
    ratios = ["repeat_char_ratio", "code_symbol_ratio", "alpha_digit_ratio"]
    return f.withColumns({r: F.round(r, 6) for r in ratios})


def quality_score(spark, folder):
    return scored_corpus(spark, folder).select("ord", "source", "quality_score", "quality_bucket")


def quality_stats(spark, folder):
    return quality.quality_stats(scored_corpus(spark, folder))


def quality_stats_default(spark, folder):
    """As ``quality_stats``, with the default rules."""
    return quality.quality_stats(scored_corpus(spark, folder, CleanConfig()))


def quality_counts(spark, folder):
    return quality.quality_counts(scored_corpus(spark, folder))


# --- sampling ---------------------------------------------------------------------------------------


def sample_by_quality(spark, folder):
    kept = sampling.sample_by_quality(scored_corpus(spark, folder))
    return kept.select("ord", "quality_score", "token_count")


def sample_by_source_ratio(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.sample_by_source_ratio(rows, RATIOS, 300).select("train_rank", "ord", "source", "quality_score", "token_count")


def sample_backfill(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.sample_by_source_ratio(rows, {"code": 3, "instruction": 1, "web": 0}, 250).select("train_rank", "ord")


def sample_large_quotas(spark, folder):
    """Quotas far above what most sources have."""
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.sample_by_source_ratio(rows, RATIOS, 60_000).select("train_rank", "ord")


def sample_topk(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.sample_by_source_ratio(rows, {}, 100).select("train_rank", "ord")


def source_quotas(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.source_quotas(rows, RATIOS, 300).select("source", "target", "available", "take", "taken_before")


def sampling_metrics(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return sampling.sampling_metrics(rows, sampling.sample_by_source_ratio(rows, RATIOS, 300), 300)


# --- parsing and schema -----------------------------------------------------------------------------


def instruction_text(spark, folder):
    return tables.load_tables(spark, folder, ("instruction",)).select("ord", "id", "text", F.col("metadata")["parser"].alias("parser"))


def html_to_text(spark, folder):
    p = tables.read_table(spark, folder, "pages", ["page_id", "html"], "page_id")
    return raw.extract_html(p, "html").select("page_id", "text")


def parse_corpus(spark, folder):
    rows = tables.load_tables(spark, folder)
    entries = F.array_join(F.array_sort(F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "|")
    return rows.select("ord", "id", "source", "language", "domain", "text", entries.alias("metadata"))


def normalize_records(spark, folder):
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text", "lang", "source", "n_chars"], "doc_id")
    given = d.select(
        F.col("doc_id").alias("id"), "text", "source", F.col("lang").alias("language"), F.col("n_chars").alias("token_count"),
        F.col("lang").alias("safety_flags"), F.create_map(F.lit("title"), F.col("source")).alias("metadata"),
    )
    n = schema.normalize_records(given)
    return n.select(
        "id", "source", "language", "domain", "token_count", "quality_score", "dedup_signature",
        F.concat_ws(",", "safety_flags").alias("flags"), "filtered", "filter_reason",
        F.concat_ws("|", *[F.col("metadata")[k] for k in ("url", "title", "parser", "version")]).alias("metadata"),
        F.length("text").cast("bigint").alias("length"),
    )


def validate_records(spark, folder):
    """The documents as they are given: their origins and some of their languages are not allowed values."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text", "lang", "source"], "doc_id")
    given = d.select("doc_id", F.col("doc_id").alias("id"), "text", "lang", F.col("source").alias("origin"))
    # Even rows get a valid source, so that later fields are looked at as well.
    source = F.when(F.col("doc_id") % 2 == 0, "document").otherwise(F.col("origin"))
    rows = schema.normalize_records(given).withColumns({"source": source, "language": F.col("lang")})
    return schema.validate_records(rows).select("doc_id", "valid", "invalid_field")


def jsonl_ingest(spark, folder):
    """Documents written as JSON lines and loaded back: ids come from the position over all files."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text", "lang"], "doc_id")
    lines = d.select("doc_id", F.to_json(F.struct(F.lit("document").alias("source"), F.col("text").alias("content"), F.col("lang").alias("language"))).alias("value"))
    path = f"{scratch_dir(spark).rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    loaded = jsonl.load_corpus(spark, path, pattern="*.txt")
    return loaded.select("ord", "id", "source", "language", F.md5("text").alias("text_md5"))


# --- report -----------------------------------------------------------------------------------------


def source_distribution(spark, folder):
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    return report.source_distribution(sampling.sample_by_source_ratio(rows, RATIOS, 300))


CLEANING = {"min_chars": 400, "max_urls": 1, "repeated_char_threshold": 8, "enable_pii_filter": False}


def config_scoping(spark, folder):
    """Verdicts under a flat configuration, one with a section (what stands beside it doesn't count), and none."""
    rows = tables.load_tables(spark, folder, ("document",))
    forms = {"flat": CLEANING, "section": {"cleaning": CLEANING, "min_chars": 1}, "none": None}
    # The texts are read and counted once, however many forms there are.
    measured = cleaning.measured(rows)
    reasons = F.array(*[F.struct(F.lit(f).alias("form"), cleaning.verdict(CleanConfig.of(c)).alias("filter_reason")) for f, c in forms.items()])
    found = once(measured, reasons=reasons).select(F.inline("reasons")).filter("filter_reason <> ''")
    return found.groupBy("form", "filter_reason").agg(F.count("*").alias("records"))


def reason_distribution(spark, folder):
    return report.filtered_reasons(cleaning.clean(tables.load_tables(spark, folder), canonical=True))


def quality_distribution(spark, folder):
    return report.quality_distribution(scored_corpus(spark, folder))


def safety_flag_hist(spark, folder):
    return report.safety_flag_counts(cleaning.clean(tables.load_tables(spark, folder), canonical=True))


def value_counts(spark, folder):
    d = tables.read_table(spark, folder, "documents", ["doc_id", "lang"], "doc_id")
    return report.value_counts(d, "lang")


def top_samples(spark, folder):
    """The best rows are chosen without texts; then only their texts are read and normalised."""
    rows = sampling.sample_by_quality(narrow_corpus(spark, folder))
    best = report.best_rows(sampling.sample_by_source_ratio(rows, RATIOS, 300)).select("ord", "train_rank", "quality_score")
    texts = tables.load_tables(spark, folder).select("ord", "source", "text").join(best, "ord")
    return report.top_samples(once(texts, text=X.normalize_text("text")))


def filtered_samples(spark, folder):
    return report.filtered_samples(cleaning.verdicts(tables.load_tables(spark, folder), keep=["ord", "source", "text"]))


def report_core(spark, folder, config=LONG_TEXTS):
    rows = materialize(scored_corpus(spark, folder, config).select("ord", "id", "source", "filtered", "quality_score", "token_count"), "scored")
    sampled = sampling.sample_by_source_ratio(sampling.sample_by_quality(rows), RATIOS, 300)
    core = report.report_core(sampled, rows)
    return core.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


def report_core_default(spark, folder):
    """As ``report_core``, with the default rules."""
    return report_core(spark, folder, CleanConfig())


# --- runs on files ----------------------------------------------------------------------------------


RAW_FILES = "*.txt.gz"


def raw_files(spark: SparkSession, folder: str) -> str:
    """The documents as compressed JSON lines in a new folder; a file is what one task writes, and reads again."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text", "lang"], "doc_id")
    lines = d.select("doc_id", F.to_json(F.struct(F.lit("document").alias("source"), F.col("text").alias("content"), F.col("lang").alias("language"))).alias("value"))
    path = f"{scratch_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    with shuffles_go(spark):
        lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.option("compression", "gzip").text(path)
    return path


def run_clean(spark, folder):
    """The clean-only run on files, read back."""
    out = runs.run_clean(spark, raw_files(spark, folder), f"{scratch_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}", pattern=RAW_FILES)
    rows = spark.read.schema("id string, source string, language string, filter_reason string, text string").json(out)
    return rows.select("id", "source", "language", "filter_reason", F.md5("text").alias("text_md5"))


def full_run(spark: SparkSession, folder: str) -> dict[str, str]:
    """The outputs of a full run on files."""
    return runs.run(spark, raw_files(spark, folder), f"{scratch_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}", CONFIG, pattern=RAW_FILES)


def run_pipeline(spark, folder):
    """The training set of a full run on files, read back."""
    rows = jsonl.read_train(spark, full_run(spark, folder)["train"])
    return rows.select("train_rank", "source", "token_count", "quality_score", F.md5("text").alias("text_md5"))


def run_duplicates(spark, folder):
    """The duplicate lists of a full run on files, read back."""
    paths = full_run(spark, folder)
    ids = spark.read.schema("id string, kept_id string").json(paths["duplicate_ids"])
    pairs = spark.read.schema("record_id string, duplicate_of string, similarity double").json(paths["duplicate_pairs"])
    ids = ids.select(F.lit("exact").alias("stage"), "id", F.col("kept_id").alias("duplicate_of"), F.lit(1.0).alias("similarity"))
    return ids.union(pairs.select(F.lit("near").alias("stage"), "record_id", "duplicate_of", "similarity"))


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics document of a full run, read back."""
    maps = "MAP<STRING,BIGINT>"
    core = "STRUCT<raw_records BIGINT, kept_records BIGINT, filtered_records BIGINT, dedup_before BIGINT, dedup_after BIGINT, duplicate_rate DOUBLE, train_records BIGINT, total_tokens BIGINT>"
    schema = (
        f"ingest STRUCT<raw_records BIGINT, records_by_source {maps}>, cleaning STRUCT<filter_reasons {maps}>, tokenizer STRUCT<token_count_by_source {maps}, length_distribution {maps}>,"
        f" quality STRUCT<quality_distribution {maps}, quality_by_source_bucket {maps}>, sampling STRUCT<quality_candidates BIGINT, train_records BIGINT>,"
        f" tables STRUCT<source_counts {maps}, source_tokens {maps}, quality_distribution {maps}, filtered_reasons {maps}, safety_flags {maps}>, core {core}"
    )
    return spark.read.schema(schema).option("multiLine", True).json(full_run(spark, folder)["metrics"])


def run_metrics(spark, folder):
    """Every table of the metrics document as rows (part, name, value)."""
    document = _metrics(spark, folder)
    parts = [
        "ingest.records_by_source", "cleaning.filter_reasons", "tokenizer.token_count_by_source", "tokenizer.length_distribution", "quality.quality_distribution",
        "quality.quality_by_source_bucket", "tables.source_counts", "tables.source_tokens", "tables.quality_distribution", "tables.filtered_reasons", "tables.safety_flags",
    ]
    named = [document.select(F.lit(p).alias("part"), F.explode(p).alias("name", "value")) for p in parts]
    totals = document.select(F.lit("sampling").alias("part"), F.expr("stack(2, 'quality_candidates', sampling.quality_candidates, 'train_records', sampling.train_records) AS (name, value)"))
    return reduce(DataFrame.union, [*named, totals])


def run_core(spark, folder):
    """The headline figures of a full run, whose totals come from the stages."""
    return _metrics(spark, folder).select("core.*").withColumn("duplicate_rate", F.round("duplicate_rate", 6))


def run_report(spark, folder):
    """The report of an exported training set, its source table read back."""
    paths = runs.run_report(spark, full_run(spark, folder)["train"], f"{scratch_dir(spark).rstrip('/')}/out-{uuid.uuid4().hex}")
    rows = spark.read.option("header", True).csv(paths["source_distribution"])
    return rows.toDF("source", "record_count", "token_count", "token_share").selectExpr(
        "source", "CAST(record_count AS BIGINT) AS record_count", "CAST(token_count AS BIGINT) AS token_count", "CAST(token_share AS DOUBLE) AS token_share"
    )


def rejected_lines(spark, folder):
    """Every third document's line is broken or no object; the others are read, these are listed."""
    d = tables.read_table(spark, folder, "documents", ["doc_id", "text"], "doc_id")
    good = F.to_json(F.struct(F.col("text").alias("content")))
    value = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("{"), good)).when(F.col("doc_id") % 3 == 1, F.to_json(F.array("text"))).otherwise(good)
    path = f"{scratch_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
    d.select("doc_id", value.alias("value")).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    found = jsonl.rejected_lines(spark, path, "*.txt").select("problem")
    return found.union(jsonl.read_jsonl(spark, path, strict=False, pattern="*.txt").select(F.lit("none"))).groupBy("problem").agg(F.count("*").alias("lines"))


# --- whole runs -------------------------------------------------------------------------------------


def train_set_default(spark, folder):
    """As ``train_set``, with the default rules."""
    return train_set(spark, folder, replace(CONFIG, cleaning=CleanConfig()))


def train_set(spark, folder, config=CONFIG):
    rows = runs.train_set(tables.load_tables(spark, folder), config)
    return rows.select("train_rank", "ord", "source", "token_count", "quality_score", F.col("metadata")["quality_bucket"].alias("bucket"), F.md5("text").alias("text_md5"))


def train_set_minhash(spark, folder):
    config = replace(CONFIG, dedup=replace(CONFIG.dedup, method="minhash"))
    rows = runs.train_set(tables.load_tables(spark, folder), config)
    return rows.select("train_rank", "ord", "source", "token_count", "quality_score")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_text, text_counters, detect_language, pii_flags, filter_reason, clean_records, clean_stats,
        clean_filter_reasons, repeated_run, info_unique_ratio, ingest_counts, exact_dedup, exact_dedup_stats,
        exact_duplicates, sha1_sig, char_ngrams, turn_jaccard, near_dedup, near_dedup_kept, near_dedup_stats,
        near_dedup_50, near_dedup_70, near_dedup_rare, minhash_near_dedup, minhash_near_dedup_70, dedup_rollup, simhash_sig, turn_hamming, tokenize, tokenize_count, token_stats,
        length_distribution, tokens_by_source, pluggable_tokenizer, tokenizer_fallback, hamming_pairs, sample_large_quotas, config_scoping, run_metrics, run_core, quality_features, quality_score, quality_stats,
        quality_counts, sample_by_quality, sample_by_source_ratio, sample_backfill, sample_topk, source_quotas,
        sampling_metrics, instruction_text, html_to_text, parse_corpus, normalize_records, validate_records,
        jsonl_ingest, source_distribution, reason_distribution, quality_distribution, safety_flag_hist, value_counts,
        top_samples, filtered_samples, report_core, train_set, train_set_minhash, quality_stats_default,
        report_core_default, train_set_default, run_clean, run_pipeline, run_duplicates, run_report, rejected_lines,
    )
}
