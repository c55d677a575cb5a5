"""What the operators of this folder share: rows as values, document keys, tables between steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.frames import materialize, ship_package

__all__ = ["as_row", "column", "first_copies", "in_arrow", "materialize", "same_document", "text_key"]


def column(name: str) -> Column:
    """A column by its plain name, also if the name holds dots."""
    return F.col(f"`{name}`")


def as_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``: the operators' own columns can't clash with the input's."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


def text_key(text: Column) -> Column:
    """A 64-bit hash that tells apart texts below one doc_id; null and empty differ.

    (doc_id, key) names a document: rows that agree in both are repeats of one row and get one result.
    """
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def same_document(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (doc_id, key); a null doc_id equals a null doc_id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["key"] == right["key"])


def first_copies(df: DataFrame) -> DataFrame:
    """One row of each (doc_id, key): repeats of a row are interchangeable."""
    return df.dropDuplicates(["doc_id", "key"])


def in_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    return ship_package(df).mapInArrow(step, schema)
