"""Integer vectors: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import once
from corpusloom.llm.rows import column

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor values that aren't finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integer_vectors(df: DataFrame, *others: str, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``others`` and ``vector`` array<bigint> of the rows whose vector is finite: floor(scale * x) of each component x.

    The product is taken in double precision; a component beyond 64 bits becomes the largest or smallest long.
    """
    valid = df.filter(finite(column(vector))).select(*[column(c).alias(c) for c in others], column(vector).alias("vector"))
    return once(valid, vector=F.transform("vector", lambda x: F.floor(x.cast("double") * F.lit(scale))))


def matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """One int64 row per vector; shorter ones are filled up with zeros, up to ``width`` or the longest of them."""
    lengths = np.diff(vectors.offsets.to_numpy())
    longest = int(lengths.max(initial=0))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = longest if width is None else width
    if len(vectors) and (lengths == width).all():
        return values.reshape(len(vectors), width)
    out = np.zeros((len(vectors), max(width, longest)), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def largest(values: np.ndarray) -> int:
    """The largest absolute value, as an integer of any size."""
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def clamped(values: np.ndarray) -> list[int]:
    """Integers held to 64 bits."""
    return [min(max(int(v), LONG_MIN), LONG_MAX) for v in values]
