"""Pairs of 64-bit signatures within a Hamming distance, as a join.

The 64 bits are cut into pieces.  Signatures that differ in at most d bits agree in all but d of them, so each signature is entered once for every
choice of (pieces - d) pieces, under their bits (Manku et al., WWW 2007), and only signatures under one entry are compared.  Equal
signatures are one entry, however many rows hold them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64


def _masks(pieces: int, max_distance: int) -> list[int]:
    """The bits of each choice of pieces, as signed longs."""
    cuts = [i * BITS // pieces for i in range(pieces + 1)]
    bits = [((1 << (end - begin)) - 1) << begin for begin, end in zip(cuts, cuts[1:], strict=False)]
    whole = [sum(chosen) for chosen in combinations(bits, pieces - max_distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in whole]


def distinct_signatures(signatures: DataFrame) -> DataFrame:
    """(simhash, ord, copies) from rows (ord, simhash): each signature once, with its first row; rows without one take no part."""
    return signatures.filter("simhash IS NOT NULL").groupBy("simhash").agg(F.min("ord").alias("ord"), F.count("*").alias("copies"))


def hamming_pairs(signatures: DataFrame, max_distance: int = 3, pieces: int | None = None) -> DataFrame:
    """(lo, hi, distance, lo_copies, hi_copies): pairs of different signatures of rows (ord, simhash) in at most ``max_distance`` bits.

    A signature is named by the first of its rows, lo < hi; its copies are all within distance 0 of each other and are counted, not
    paired (``distinct_signatures`` tells them).  ``pieces`` has to be more than ``max_distance``; more pieces make more entries per signature and shorter
    buckets: the default of three more than the distance enters each signature under half of its bits, 20 times for a distance of 3.
    """
    pieces = max_distance + 3 if pieces is None else pieces
    if not 0 <= max_distance < pieces <= BITS:
        raise ValueError("the bits have to be cut into more pieces than may differ")
    masks = _masks(pieces, max_distance)
    entries = distinct_signatures(signatures).select(
        "simhash", "ord", "copies", F.posexplode(F.array(*[F.col("simhash").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "bits")
    )
    a, b = entries.alias("a"), entries.alias("b")
    differing = F.col("a.simhash").bitwiseXOR(F.col("b.simhash"))
    # Of all entries that a pair shares the first one counts, so no pair comes twice.
    first: Column = F.coalesce(*[F.when(differing.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    same = (F.col("a.choice") == F.col("b.choice")) & (F.col("a.bits") == F.col("b.bits")) & (F.col("a.ord") < F.col("b.ord"))
    near = a.join(b, same & (F.bit_count(differing) <= max_distance) & (first == F.col("a.choice")))
    return near.select(
        F.col("a.ord").alias("lo"), F.col("b.ord").alias("hi"), F.bit_count(differing).cast("bigint").alias("distance"),
        F.col("a.copies").alias("lo_copies"), F.col("b.copies").alias("hi_copies"),
    )
