"""Cleaning on a stream of JSONL files: the same row-level operators as in batch, file by file as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.cleaning import clean
from corpusloom.plans.config import CleanConfig
from corpusloom.sources.jsonl import parsed_lines, raw_fields
from corpusloom.sources.raw import parse_raw


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.readStream.option("pathGlobFilter", "*.jsonl").text(folder)
    return parsed_lines(lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "value"))


def clean_stream(spark: SparkSession, folder: str, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned rows of new ``*.jsonl`` files, parsed as in batch; lines that aren't JSON objects are in ``rejected_stream``.

    Positions over all files do not exist here, so ids stay as given.
    """
    return clean(parse_raw(raw_fields(_lines(spark, folder).filter("problem IS NULL"))), config, canonical=True)


def rejected_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(path, value, problem) of the lines of new files that aren't JSON objects."""
    return _lines(spark, folder).filter("problem IS NOT NULL").select("path", "value", "problem")


def run_clean_stream(spark: SparkSession, folder: str, output: str, checkpoint: str, config: CleanConfig = CleanConfig()) -> StreamingQuery:
    """Clean what is there now and stop; call again for what came since."""
    return _start(clean_stream(spark, folder, config), output, checkpoint, "filtered")


def run_rejected_stream(spark: SparkSession, folder: str, output: str, checkpoint: str) -> StreamingQuery:
    """Gather the broken lines of what is there now and stop."""
    return _start(rejected_stream(spark, folder), output, checkpoint, "problem")


def _start(rows: DataFrame, output: str, checkpoint: str, partition: str) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.partitionBy(partition).trigger(availableNow=True).start(output)
