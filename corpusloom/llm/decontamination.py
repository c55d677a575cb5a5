"""Benchmark decontamination by winnowing; DataFrame operations only.

Of every window of consecutive k-gram hashes the smallest is kept (the leftmost of equals).  Two texts that share a span of
k + w - 1 words keep the same hash at the same place of the span, so a join of kept hashes meets every shared span of
that length.  A hit is extended to the windows around it, each of which is looked up among the different windows of the benchmark;
items come in last, so a window that many items share is compared once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import once
from corpusloom.llm.ngrams import paired, winnowed, with_run_hashes, word_hashes
from corpusloom.llm.rows import as_row, column, materialize, same_document, text_key

WINDOW = 13  # words of a benchmark window
GRAM = 8  # words of a k-gram; a shared window of 13 words spans 6 of them
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words once A-Z are in lower case
_BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # in a text of any case


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of 0-9, a-z and non-ASCII characters, A-Z in lower case; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)  # then lower() changes A-Z alone, and is much faster
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.filter(F.split(low, _BETWEEN), lambda w: w != ""), F.array().cast("array<string>"))


def fingerprints(words: DataFrame, lengths: list[int], *names: str) -> DataFrame:
    """(names, span, at, hash, around): winnowed k-grams of ``words``, such that texts with a common span of any of ``lengths`` share one there.

    ``around`` holds the hashes of the whole spans around the k-gram: element d begins d words before it, null if that isn't in the text.
    """
    hashed = once(words.filter(F.size("words") >= min(lengths)), each=word_hashes(F.col("words"))).drop("words")
    kept = []
    for length in lengths:
        gram = min(GRAM, length)
        hashed = with_run_hashes(hashed, "each", gram, f"grams{length}")
        hashed = once(hashed, **{f"whole{length}": paired(f"grams{length}", length - gram)})
        kept.append(_marks(length, length - gram + 1))
    return hashed.select(*names, F.inline(F.concat(*kept)))


def _marks(length: int, window: int) -> Column:
    """The winnowed grams of a text that has at least ``length`` words, with the spans that they stand for."""

    def mark(m: Column) -> Column:
        begins = [m["at"] - d for d in range(window)]
        around = F.array(*[F.when(i <= F.size("each") - length, F.get(F.col(f"whole{length}"), i)) for i in begins])
        return F.struct(F.lit(length).alias("span"), m["at"].alias("at"), m["hash"].alias("hash"), around.alias("around"))

    marks = F.transform(winnowed(F.col(f"grams{length}"), window), mark)
    return F.when(F.size("each") >= length, marks).otherwise(F.array().cast("array<struct<span:int,at:int,hash:bigint,around:array<bigint>>>"))


def n_words_of(text: Column) -> Column:
    """How many words a text has; counting needs no lower case."""
    return F.when(text.isNull(), 0).otherwise(F.size(F.filter(F.split(text, _BETWEEN_ANY), lambda w: w != ""))).cast("long")


def _windows(benchmark: DataFrame) -> DataFrame:
    """(span, hash, there, window, ids, bearers): the different windows of the benchmark by their kept k-gram, its place and their own hash, with the
    ids of the items that hold them and a digest of these."""
    words = benchmark.select(column("item_id").cast("string").alias("item_id"), words_of(column("text")).alias("words")).filter("size(words) > 0")
    texts = once(words.groupBy("words").agg(F.collect_set("item_id").alias("ids")), span=F.least(F.size("words"), F.lit(WINDOW)))
    cut = F.expr("transform(sequence(0, size(words) - span), i -> slice(words, i + 1, span))")
    each = texts.select("ids", F.explode(F.array_distinct(cut)).alias("words")).select("words", F.explode_outer("ids").alias("item_id"))
    held = each.groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    spans = sorted(r["span"] for r in texts.select("span").distinct().collect()) or [WINDOW]  # at most 13 numbers
    marks = fingerprints(held.select("words", "ids", F.size("words").alias("its_span")), spans, "ids", "its_span").filter("span = its_span")
    return marks.select("span", "hash", F.col("at").alias("there"), F.get("around", "at").alias("window"), "ids", F.md5(F.to_json("ids")).alias("bearers"))


def _occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, bearers, begin, end): places of benchmark windows in documents, as word numbers from 0; end is exclusive.

    A kept hash of a document meets only the places that it has inside of windows (at most 6), however many windows and
    items share it.  The window around it carries its own hash, which is then looked up, so texts are read once and never
    shuffled.  Both 64-bit hashes have to agree.
    """
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())  # at most 13 numbers
    if not spans:
        return docs.select("doc_id", "key", F.lit("").alias("bearers"), F.lit(0).alias("begin"), F.lit(0).alias("end")).limit(0)
    ours = fingerprints(docs.select("doc_id", "key", words_of(F.col("text")).alias("words")), spans, "doc_id", "key")
    met = ours.join(windows.select("span", "hash", "there").distinct(), ["span", "hash"])
    met = met.select("doc_id", "key", "span", "hash", "there", (F.col("at") - F.col("there")).alias("begin"), F.get("around", "there").alias("window"))
    same = met.filter("window IS NOT NULL").join(windows.drop("ids"), ["span", "hash", "there", "window"])
    return same.select("doc_id", "key", "bearers", "begin", (F.col("begin") + F.col("span")).alias("end"))


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(column("doc_id").cast("long").alias("doc_id"), text_key(column("text")).alias("key"), column("text").alias("text"))


def _verdicts(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, n_hit, held) of the documents that hold a benchmark window; held: the sorted digests of the id sets of their windows."""
    places = _occurrences(rows, windows)
    lists = places.groupBy("doc_id", "key").agg(F.collect_set(F.struct("begin", "end")).alias("places"), F.array_sort(F.collect_set("bearers")).alias("held"))
    covered = F.aggregate(
        F.array_sort("places"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda acc, p: F.struct((acc["n"] + F.greatest(p["end"] - F.greatest(p["begin"], acc["upto"]), F.lit(0))).alias("n"), F.greatest(acc["upto"], p["end"]).alias("upto")),
        lambda acc: acc["n"],
    )
    return lists.select("doc_id", "key", covered.alias("n_hit"), "held")


def _lists(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(held, item_ids, n_items, items_sha256): the ids behind each different ``held``, put together once however many documents have it."""
    sets = windows.groupBy("bearers").agg(F.first("ids").alias("ids"))
    each = found.select("held").distinct().select("held", F.explode("held").alias("bearers")).join(sets, "bearers")
    ids = each.select("held", F.explode_outer("ids").alias("item_id")).groupBy("held").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return ids.select("held", "item_ids", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per input row: doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated, item_ids.

    A benchmark window is 13 consecutive words of an item, or all words of a shorter item; a document word inside any
    occurrence of a window is hit.  item_ids are the items with an occurring window, as strings in order, items_sha256
    the digest of their comma-joined list.  A document is contaminated if at least a twentieth of its words is hit.  Null
    and blank texts have no words.  An item without id counts for hits but isn't listed; items without words are ignored; items with
    equal words are all listed.  Repeated rows get equal results.  Empty tables give no hits, or no rows.  Other columns
    are ignored.
    """
    rows = _read(docs)
    windows = materialize(_windows(benchmark), "windows")
    found = materialize(_verdicts(rows, windows), "verdicts")
    listed = found.join(_lists(found, windows), "held").drop("held")
    counted = rows.select("doc_id", "key", n_words_of(F.col("text")).alias("n_words"))
    n_hit, none = F.coalesce("n_hit", F.lit(0).cast("long")), F.sha2(F.lit(""), 256)
    return counted.join(listed, same_document(counted, listed), "left").select(
        counted["doc_id"], counted["key"], "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay as they are, rows without doc_id or text included."""
    rows = docs.select(as_row(docs), column("doc_id").cast("long").alias("doc_id"), text_key(column("text")).alias("key"), column("text").alias("text"))
    found = _verdicts(_read(docs), materialize(_windows(benchmark), "windows"))
    marked = rows.join(found.select(F.col("doc_id").alias("its_id"), F.col("key").alias("its_key"), "n_hit"), F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("key") == F.col("its_key")), "left")
    # Only rows with a hit have their words counted.
    spoiled = F.col("n_hit").isNotNull() & (20 * F.col("n_hit") >= n_words_of(F.col("text")))
    return marked.filter(~F.coalesce(spoiled, F.lit(False))).select("row.*")
