"""Contiguous shards of near equal bytes from global prefix sums; DataFrame operations only.

Rows are range-sorted by doc_id.  Each range partition is summed on its own, the few partition totals are summed in
order, and a row's place in the whole is what stands before its partition plus what stands before it inside.  No step
depends on where the partitions were cut, so the result is the same for any number of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.rows import column, materialize


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty.  Rows in order of doc_id (null first, ties by size and checksum;
    rows equal in all three are interchangeable) lie on a line of all sizes; the line is cut at ``shards`` equal
    targets and a row belongs to the part that holds its middle, so a shard differs from its target by at most one row's
    size.  slot counts a shard's rows from 0.  A row larger than a target leaves shards empty.  Equal texts are not
    kept together: a group of copies may be larger than a shard.  grown_shard is null: this law moves rows when
    the number of shards changes.  An empty table gives an empty result; other columns are ignored.
    """
    size = (F.octet_length(F.coalesce(column("text"), F.lit(""))) + 1).cast("long")
    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(column("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    # A row's number in the scan keeps the order total, so that even a third of all rows with one doc_id is spread.
    narrow = materialize(narrow.withColumn("nth", F.monotonically_increasing_id()), "sizes")
    keys = ["doc_id", "size", "text_crc32", "nth"]
    ranged = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*[F.col(k).asc_nulls_first() for k in keys]).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("whole"),
    )
    before = F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = ranged.select(*keys, "part", before.alias("before"), F.count("size").over(inside).alias("nth_inside")).join(totals, "part")
    middle = (2 * (F.col("bytes_before") + F.col("before")) + F.col("size")).cast("decimal(20,0)")
    shard = F.floor(middle * shards / (2 * F.col("whole").cast("decimal(19,0)"))).cast("int")
    placed = placed.select("doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("nth_inside")).alias("place"), shard.alias("shard"))
    placed = materialize(placed, "places")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
