"""Corpus tables in Parquet -> raw records.

``documents`` become source document, ``conversations`` source instruction (see :func:`turn_records`),
``pages`` source web.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.frames import spread
from corpusloom.sources.raw import parse_raw

# Sources in file-name order; the place goes above the key in ``ord``, so a key has 56 bits.
PLACES = {"code": 0, "document": 1, "instruction": 2, "web": 3}
KEY_BITS = 56
TURN_BITS = 16


def ord_of(source: str, key: Column) -> Column:
    return F.lit(PLACES[source] << KEY_BITS) + key.cast("bigint")


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str], key: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet").select(*columns), key)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    d = read_table(spark, folder, "documents", ["doc_id", "text", "lang", "source"], "doc_id")
    return d.select(
        ord_of("document", F.col("doc_id")).alias("ord"),
        F.format_string("document-%d", "doc_id").alias("id"),
        "text",
        F.lit("document").alias("source"),
        F.col("lang").alias("language"),
        F.create_map(F.lit("origin"), F.col("source")).alias("metadata"),
    )


def turn_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, question, answer): a user turn and the assistant turn right after it."""
    c = read_table(spark, folder, "conversations", ["conv_id", "turn", "role", "text"], "conv_id")
    after = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("next_role", F.lead("role").over(after)).withColumn("answer", F.lead("text").over(after))
    return c.filter("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


def turn_records(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, instruction, input, output, text): every turn of a conversation is part of one record.

    A user turn is a record: the assistant turn right after it is its output (empty if there is none), the system turn
    right before it its input.  An assistant turn without a user turn right before it is a record of its own output, any
    other turn (a system turn without a user turn right after it) a record of its own text.
    """
    c = read_table(spark, folder, "conversations", ["conv_id", "turn", "role", "text"], "conv_id")
    order = Window.partitionBy("conv_id").orderBy("turn")
    text, empty = F.coalesce("text", F.lit("")), F.lit("")
    c = c.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("own"))
    sides = {"role_before": F.lag("role"), "before": F.lag("own"), "role_after": F.lead("role"), "after": F.lead("own")}
    c = c.withColumns({name: F.coalesce(value.over(order), empty) for name, value in sides.items()})
    user, answer = F.col("role") == "user", F.col("role") == "assistant"
    given = F.when(user & (F.col("role_before") == "system"), F.col("before")).otherwise(empty)
    output = F.when(user & (F.col("role_after") == "assistant"), F.col("after")).when(answer, F.col("own")).otherwise(empty)
    taken = (answer & (F.col("role_before") == "user")) | ((F.col("role") == "system") & (F.col("role_after") == "user"))
    return c.filter(~taken).select(
        "conv_id",
        "turn",
        F.when(user, F.col("own")).otherwise(empty).alias("instruction"),
        given.alias("input"),
        output.alias("output"),
        F.when(user, given).otherwise(F.col("own")).alias("text"),
    )


def instructions(spark: SparkSession, folder: str) -> DataFrame:
    fits = F.col("turn").between(0, (1 << TURN_BITS) - 1)
    key = F.when(fits, F.col("conv_id") * (1 << TURN_BITS) + F.col("turn")).otherwise(F.raise_error(F.lit("turn beyond the key's bits")).cast("bigint"))
    return turn_records(spark, folder).select(
        ord_of("instruction", key).alias("ord"),
        F.format_string("conversation-%d-%d", "conv_id", "turn").alias("id"),
        F.lit("instruction").alias("source"),
        "instruction",
        "input",
        "output",
        "text",
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    p = read_table(spark, folder, "pages", ["page_id", "url", "html"], "page_id")
    return p.select(
        ord_of("web", F.col("page_id")).alias("ord"),
        F.format_string("page-%d", "page_id").alias("id"),
        F.lit("web").alias("source"),
        "url",
        "html",
    )


def load_tables(spark: SparkSession, folder: str, sources: tuple[str, ...] = ("document", "instruction", "web")) -> DataFrame:
    """Canonical records of the chosen tables, with ``ord``."""
    readers = {"document": documents, "instruction": instructions, "web": pages}
    frames = [parse_raw(readers[s](spark, folder), only=s) for s in sources]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
