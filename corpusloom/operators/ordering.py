"""Dense positions in a total order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.frames import materialize

_ROW_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in its low 33 bits


def add_position(df: DataFrame, order: list[Column], name: str = "position", within: str | None = None) -> DataFrame:
    """Add the 1-based position of each row, overall or inside of each ``within`` group.

    The order has to be total.  Rows are range-partitioned (a hot group spreads over many partitions),
    numbered inside their partition, and shifted by what the partitions before hold.  Only one row per
    partition and group takes part in the running sum.  The numbered rows are written first, because a
    second range partitioning could cut elsewhere; so keep ``df`` narrow.
    """
    keys = ([F.col(within)] if within else []) + order
    numbered = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))),
        "position",
    )
    group = [within] if within else []
    pieces = numbered.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_part", *group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return numbered.join(pieces, ["_part", *group]).select(*df.columns, position.alias(name))


BINS = 10_000  # of a score between 0 and 1; any other score falls into the first or the last


def top_rows(df: DataFrame, order: list[Column], takes: int | dict[str, int], name: str, score: str = "quality_score", within: str | None = None) -> DataFrame:
    """The first rows of a total order with their position: ``takes`` of all, or of each ``within`` group as many as ``takes`` says.

    The order has to begin with the highest ``score``.  A histogram of the scores (at most ``BINS`` + 1 rows per wanted group) tells which bin the
    last row that is taken falls in, so only rows of that bin and above are brought into order; as many as that may be, they are spread over
    range partitions.
    """
    spark = df.sparkSession
    wanted = {k: n for k, n in (takes if within else {None: takes}).items() if n > 0}
    if not wanted:
        return df.limit(0).withColumn(name, F.lit(0).cast("bigint"))
    # Not a number sorts above all numbers, null below.
    bin_ = F.when(F.isnan(score), BINS).otherwise(F.coalesce(F.least(F.greatest(F.floor(F.col(score) * BINS), F.lit(0)), F.lit(BINS)), F.lit(0))).cast("int")
    binned = df.withColumn("_bin", bin_)
    if within:
        binned = binned.filter(F.col(within).isin(list(wanted)))
    lowest = dict.fromkeys(wanted, 0)
    left = dict(wanted)
    counts = binned.groupBy(*([within] if within else []), "_bin").agg(F.count("*").alias("_n"))
    for row in sorted(counts.collect(), key=lambda r: -r["_bin"]):
        group = row[within] if within else None
        if left[group] > 0:
            left[group] -= row["_n"]
            lowest[group] = row["_bin"] if left[group] <= 0 else 0
    if within:
        cuts = spark.createDataFrame([(g, lowest[g], n) for g, n in wanted.items()], f"{within} string, _lowest int, _take bigint")
        binned = binned.join(F.broadcast(cuts), within)  # a row per wanted group
    else:
        binned = binned.withColumns({"_lowest": F.lit(lowest[None]), "_take": F.lit(wanted[None]).cast("bigint")})
    first = add_position(binned.filter("_bin >= _lowest").drop("_bin", "_lowest"), order, name, within)
    return first.filter(F.col(name) <= F.col("_take")).select(*df.columns, name)
