"""The training-data pipeline: language, near-duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.frames import scratch_dir
from corpusloom.llm.decontamination import drop_contaminated
from corpusloom.llm.language_id import keep_identified
from corpusloom.llm.packing import pack
from corpusloom.llm.queries import word_tokenizer
from corpusloom.llm.simhash_dedup import drop_near_duplicates
from corpusloom.llm.substring_dedup import drop_repeated_sentences


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough margin; learned from this stage's documents that aren't held out."""
    return keep_identified(docs, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier in the corpus; n_chars follows the new text (a null text keeps it)."""
    cleaned = drop_repeated_sentences(docs)
    if "n_chars" not in cleaned.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, word_tokenizer)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Models, tokenizers and stable fingerprints are beyond SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
