"""Exact deduplication and SimHash signatures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import patterns as P
from corpusloom.functions import text as X
from corpusloom.functions.frames import materialize, once


def with_signature(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``dedup_signature``: MD5 of the text's hash form."""
    return once(df, dedup_signature=F.md5(X.hash_form(text)))


@dataclass(frozen=True)
class ExactDedup:
    """Frames that describe an exact deduplication by ``dedup_signature``, keeping the smallest ``ord``."""

    rows: DataFrame  # all input rows, with their signature
    signatures: DataFrame  # ord, id, dedup_signature of all input rows
    first: DataFrame  # dedup_signature, first_ord, copies

    @property
    def kept(self) -> DataFrame:
        """The surviving rows: all but the removed ones, which are few and narrow.

        Wide rows are never ranked or grouped, and need no shuffle where the removed rows fit a broadcast.
        """
        return self.rows.join(self.removed, "ord", "left_anti")

    @property
    def removed(self) -> DataFrame:
        """(ord) of each row that is a copy of an earlier one."""
        repeated = self.first.filter("copies > 1").select("dedup_signature", "first_ord")
        return self.signatures.select("ord", "dedup_signature").join(repeated, "dedup_signature").filter("ord > first_ord").select("ord")

    @property
    def duplicates(self) -> DataFrame:
        """(ord, id, kept_id) of each removed row.

        Many rows may meet one signature here; the other side has one row per signature, which is the
        shape that adaptive skew handling splits.
        """
        narrow = self.signatures
        repeated = self.first.filter("copies > 1").select("dedup_signature", "first_ord")
        kept = (
            narrow.join(repeated.select(F.col("first_ord").alias("ord")), "ord", "left_semi")
            .select("dedup_signature", F.col("id").alias("kept_id"), F.col("ord").alias("kept_ord"))
        )
        return narrow.join(kept, "dedup_signature").filter("ord > kept_ord").select("ord", "id", "kept_id")

    @property
    def stats(self) -> DataFrame:
        return self.first.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("input_records"),
            F.count("*").alias("output_records"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        ).select(F.lit("md5_exact").alias("method"), "*")


def exact_dedup(df: DataFrame, prepared: bool = False) -> ExactDedup:
    """Keep the first row (by ``ord``) of each group of equal texts.

    The grouping moves one (signature, min, count) row per group and map task, so a group that holds a
    third of the corpus costs no more than any other.  With ``prepared`` the rows are a table that holds their signature
    already; otherwise the signatures are written once, because they are read several times.
    """
    rows = df if prepared else with_signature(df)
    signatures = rows.select("ord", "id", "dedup_signature")
    signatures = signatures if prepared else materialize(signatures, "signatures")
    first = signatures.groupBy("dedup_signature").agg(F.min("ord").alias("first_ord"), F.count("*").alias("copies"))
    return ExactDedup(rows, signatures, first)


def dedup_rollup(input_records: int, output_records: int) -> dict[str, float]:
    removed = input_records - output_records
    return {
        "input_records": input_records,
        "output_records": output_records,
        "duplicates_removed": removed,
        "duplicate_rate": removed / input_records if input_records else 0,
    }


def simhash_signatures(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, simhash): the 64-bit SimHash of each row as a BIGINT bit pattern.

    Every token votes on 64 bits.  Two votes share one BIGINT sum (bits i and i+32 in its halves), so a
    row needs 32 sums, which are combined map-side before the shuffle: tokens of a row sit together.
    """
    found = F.regexp_extract_all(X.hash_form(text), F.lit(P.SIMHASH_TOKEN), F.lit(0))
    votes = df.select(key, F.explode_outer(found).alias("_token")).select(key, X.token_hash64(F.col("_token")).alias("_h"))
    two_bits = F.lit(0x0000000100000001)
    sums = [F.coalesce(F.sum(F.shiftright("_h", i).bitwiseAND(two_bits)), F.lit(0)).alias(f"_s{i}") for i in range(32)]
    voted = votes.groupBy(key).agg(F.count("_h").alias("_n"), *sums)

    def bit(i: int) -> Column:
        half = F.col(f"_s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(f"_s{i - 32}", 32)
        weight = (1 << i) if i < 63 else -(1 << 63)
        return F.when(half * 2 >= F.col("_n"), F.lit(weight).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    packed = bit(0)
    for i in range(1, 64):
        packed = packed.bitwiseOR(bit(i))
    return voted.select(key, packed.alias("simhash"))
