"""Hashes of runs of words inside of an array column, by DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import once


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def with_run_hashes(df: DataFrame, each: str, size: int, name: str) -> DataFrame:
    """Add, for every element of the array ``each``, the 64-bit hash of it and the ``size`` - 1 elements after it.

    Runs are put together from two shorter runs, so an element costs a few lookups whatever the size is.  (A slice
    per element would copy boxed values.)  The last ``size`` - 1 hashes are those of the incomplete runs at the end.
    """
    have, source = 1, each
    while have < size:
        step = min(have, size - have)
        df = once(df, **{name: paired(source, step)})
        have, source = have + step, name
    return df if size > 1 else df.withColumn(name, F.col(each))


def paired(source: str, step: int) -> Column:
    """Each hash joined with the one ``step`` places after it; the hash itself if there is none or ``step`` is 0."""
    if step == 0:
        return F.col(source)
    return F.transform(source, lambda h, i: F.xxhash64(h, F.get(F.col(source), i + step)))


def winnowed(hashes: Column, window: int) -> Column:
    """Of each run of ``window`` hashes, the smallest, the leftmost of equals, as structs (at, hash); every place once.

    A place is kept if some window around it has only larger hashes to its left and no smaller one to its right: first
    the larger ones to its left are counted, then enough others are looked for to its right.  Places outside of the array
    are null, which keeps no window.
    """

    def kept(own: Column, i: Column, left: int = 0) -> Column:
        if left == window - 1:
            return F.lit(True)
        right = F.lit(True)
        for d in range(1, window - left):
            right = right & (F.get(hashes, i + d) >= own)
        return F.when(F.get(hashes, i - left - 1) > own, kept(own, i, left + 1)).otherwise(right)

    marks = F.transform(hashes, lambda h, i: F.when(kept(h, i), F.struct(i.alias("at"), h.alias("hash"))))
    return F.filter(marks, lambda m: m.isNotNull())
