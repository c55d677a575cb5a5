"""Near-duplicates by SimHash: byte-position postings, count filter, verification by bit distance.

Two 64-bit fingerprints that differ in at most d bits agree in at least 8 - d of their 8 bytes.  A posting list for
one positional byte would hold 1/256 of the corpus and pair it with itself, so a posting stands for 8 - d positional
bytes at once: a pair shares one exactly if its tally reaches the guaranteed minimum.  Only different fingerprints
meet in postings; documents with equal fingerprints are one entry from the start, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.rows import as_row, column, first_copies, in_arrow, materialize, same_document, text_key

SEED = 42
_AT_ONCE = 1 << 15  # shingles whose bits are unpacked together


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of a whole text as a signed 64-bit number; a text without words has 0."""
    words = (text or b"").lower().split()  # of bytes, lower() and split() know ASCII only
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _AT_ONCE):
        part = zip(starts[i : i + _AT_ONCE], ends[i : i + _AT_ONCE], strict=True)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in part), np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, key, fingerprint) of every document, written once."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("key"), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "fingerprint"])

    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), text_key(column("text")).alias("key"), column("text").cast("binary").alias("text"))
    return materialize(in_arrow(narrow, step, "doc_id long, key long, fingerprint long"), "simhash")


def _byte(x: Column, position: int) -> Column:
    return F.shiftrightunsigned(x, 8 * position).bitwiseAND(F.lit(255))


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b, bits): the pairs a < b of different fingerprints at most ``max_bits`` apart, each once."""
    least = 8 - max_bits
    if least < 1:
        raise ValueError("a count filter over 8 bytes needs max_bits of 7 or fewer")
    masks = [sum(255 << 8 * p for p in kept) for kept in combinations(range(8), least)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    postings = prints.select("fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("places", "bytes"))
    left = postings.withColumnRenamed("fingerprint", "a")
    right = postings.withColumnRenamed("fingerprint", "b")
    # Spark sizes postings like the fingerprints that they come from, which are many times fewer, and would broadcast them through the driver.
    pairs = left.join(right.hint("merge"), ["places", "bytes"]).filter("a < b")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((F.when(_byte(apart, p) == 0, 1).otherwise(0) for p in range(8)), F.lit(0))
    kept = pairs.filter((tally >= least) & (F.bit_count(apart) <= max_bits))
    return kept.select("a", "b", F.bit_count(apart).alias("bits")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: doc_id, key (hash of its text), fingerprint (long), root, component_id.

    A text's fingerprint sets the bits that are set in over half of the XXH64 values of its word shingles (A-Z in lower
    case, repeats counted; fewer words than a shingle: the whole sequence).  Null, empty and blank texts have fingerprint
    0 and are linked like any other.  Documents link at ``max_bits`` or fewer differing bits; a component is everything
    reachable over links.  root is its smallest fingerprint, component_id its smallest doc_id; rows with a null doc_id
    link others but never name a component, so a component of such rows alone has a null component_id.  Repeated rows
    are rows of their own with equal results.  An empty table gives an empty result.  Other columns are ignored.
    """
    rows = fingerprints(docs, shingle)
    prints = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    joined = components(links(prints, max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = prints.join(joined, "fingerprint", "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # Most components are one fingerprint; only the others need the name of their root.
    moved = rooted.join(named, "root").select("fingerprint", "root", "component_id")
    return rows.join(moved, "fingerprint").select("doc_id", "key", "fingerprint", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document per component of ``near_duplicates``: the smallest doc_id (null last), then the smallest key.

    All columns stay as they are.  Of repeated rows one stays.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    kept = near_duplicates(docs, shingle, max_bits).groupBy("root").agg(F.min(rank).alias("kept")).select("kept.doc_id", "kept.key")
    rows = docs.select(as_row(docs), column("doc_id").cast("long").alias("doc_id"), text_key(column("text")).alias("key"))
    chosen = rows.join(kept, same_document(rows, kept), "left_semi")
    return first_copies(chosen).select("row.*")
