"""Token counts and their statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chars as C
from corpusloom.functions import text as X
from corpusloom.functions.frames import ship_package
from corpusloom.functions.rounding import python_round

BUILTIN_TOKENIZER = "simple_fallback_tokenizer"


@dataclass(frozen=True)
class Tokenizer:
    """What counts tokens: the built-in rule, or a loader for anything with ``count`` or ``tokenize``.

    ``load`` runs once per Python worker; it has to be picklable, and so has nothing that it returns.
    """

    name: str = BUILTIN_TOKENIZER
    load: Callable[[], object] | None = None
    error: str = ""

    def checked(self, spark: SparkSession) -> Tokenizer:
        """This tokenizer if it loads on the workers, else the built-in rule with the error noted.

        A file or a package may be there on the driver alone, so the workers are asked, by a task for each core.
        """
        if self.load is None:
            return self
        load = self.load

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _ in batches:
                pass
            try:
                _counter(load())("probe")
                failures = []
            except Exception as failure:  # whatever goes wrong in user code leads to the fallback
                failures = [str(failure) or type(failure).__name__]
            yield pa.RecordBatch.from_arrays([pa.array(failures, pa.string())], names=["error"])

        cores = spark.sparkContext.defaultParallelism
        failed = ship_package(spark.range(cores, numPartitions=cores)).mapInArrow(probe, "error string").agg(F.min("error")).first()[0]
        return self if failed is None else Tokenizer(error=failed)

    def count(self, text: str) -> Column:
        if self.load is None:
            return X.token_count(text)
        load = self.load

        @F.pandas_udf("bigint")
        def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            count = _counter(load())
            for batch in batches:
                yield batch.map(count)

        return counted(F.coalesce(F.col(text), F.lit("")))


def _counter(tokenizer: object) -> Callable[[str], int]:
    if hasattr(tokenizer, "count"):
        return lambda text: int(tokenizer.count(text))
    return lambda text: len(tokenizer.tokenize(text))


def add_token_counts(df: DataFrame, tokenizer: Tokenizer = Tokenizer()) -> DataFrame:
    """Set ``token_count``."""
    count = C.token_count("text", C.classes_of(df.sparkSession)) if tokenizer.load is None else tokenizer.count("text")
    return ship_package(df).withColumn("token_count", count)


def token_stats(df: DataFrame) -> DataFrame:
    """One row: total, average (2 digits), minimum and maximum; zeros for an empty input."""
    n = F.col("token_count")
    totals = df.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_tokens"),
        F.coalesce(F.min(n), F.lit(0)).alias("min_tokens"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_tokens"),
    )
    return totals.withColumn("avg_tokens", python_round(F.col("avg_tokens"), 2))


def tokens_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.sum("token_count").alias("tokens"))


def length_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(X.length_bucket("token_count").alias("length_bucket")).agg(F.count("*").alias("records"))
