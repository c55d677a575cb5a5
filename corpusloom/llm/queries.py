"""The registered query of each operator: whole tables, production parameters, the columns that its contract names."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.frames import scratch_dir
from corpusloom.llm.bpe_count import count_tokens
from corpusloom.llm.conversation_repair import damage, repair
from corpusloom.llm.decontamination import contamination
from corpusloom.llm.language_id import identify
from corpusloom.llm.licenses import scan_licenses
from corpusloom.llm.line_quality import clean_lines
from corpusloom.llm.packing import pack
from corpusloom.llm.sharding import shard_by_bytes
from corpusloom.llm.simhash_dedup import near_duplicates
from corpusloom.llm.substring_dedup import drop_repeated_sentences
from corpusloom.llm.topk_search import top_k
from corpusloom.llm.vector_codes import codebooks_digest, encode, label_errors
from corpusloom.llm.vectors import integer_vectors
from corpusloom.llm.warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = drop_repeated_sentences(docs, counts=("n_sentences", "n_removed"))
    return cleaned.select("doc_id", "text", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), word_tokenizer)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(_table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(_table(spark, sf_dir, "documents"), shards=8)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, docs)


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(_table(spark, sf_dir, "documents")).drop("clean_text", "lost")


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), byte_tokenizer)


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(_table(spark, sf_dir, "conversations")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = encode(_table(spark, sf_dir, "embeddings"))
    whole = coded.join(label_errors(coded), F.col("label").eqNullSafe(F.col("its_label")))
    return whole.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_packing, op3_warc, op4_simhash_dedup, op5_sharding, op6_decontamination, op7_licenses, op8_language_id,
        op9_line_quality, op10_token_count, op11_topk_search, op12_conversation_repair, op13_vector_codes,
    )
}
