"""Hierarchical packing into context windows of several sizes.

Each document is routed to a tier, the smallest window size that holds it (or the largest size), and the documents of a tier are laid on a line one behind the
other.  The line is cut at the ends of the tier's windows, so every window is full; what the last window of a tier lacks is filled with the first documents of the
next shorter tier, whose own windows begin behind it.  So all tiers together are one line, and all sequences but the very last are full windows.

A document's place on the line follows from sums: of the tiers before, of the scan tasks before, and of the task's own documents before, which the tasks
count while they tokenize.  No text or id is shuffled.  The order on the line is that of the table as it was read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bpe_count import byte_symbols
from corpusloom.llm.cache import TwoGenerations
from corpusloom.llm.rows import column, in_arrow, materialize

WINDOWS = (512, 1024, 2048, 4096)
STEP = 64  # sequences of the largest size in a step group, or as many smaller ones as hold the same number of tokens
CACHED = 250_000  # words in each of a worker's two generations of known ids
_CACHED_LENGTH = 64


# Fixed value: how the tokenizer splits text without white space, in lower case, before merging.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
_LATIN = "\u0250"  # characters before this one are composed already
_BEYOND = regex.compile(r"[^\x00-\u024f]")
_SYMBOLS = {b: ord(c) for c, b in byte_symbols().items()}  # of bytes, taken as Latin-1 characters


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, by way of the words between spaces.

    For a tokenizer that drops white space and never merges across it, a text's ids are its words' ids in order.  New
    words of printable Latin characters go to the tokenizer's merges directly, others through all of its steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        self.known = TwoGenerations(self.word, CACHED, _CACHED_LENGTH)

    def word(self, word: str) -> bytes:
        low = word.lower()
        if not low or max(low) >= _LATIN or not low.isprintable() or "<|" in low:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if low.isalpha():
            pieces = [low]
        elif low[:-1].isalpha() and low[-1] in ".,;:!?":
            pieces = [low[:-1], low[-1]]
        else:
            pieces = _PIECES.findall(low)
        merged, out = self.merged, array("I")
        for p in pieces:
            out.extend([t.id for t in merged(p if p.isascii() else p.encode().decode("latin-1").translate(_SYMBOLS))])
        return out.tobytes()

    def of(self, text: str) -> bytes:
        if "<|" not in text and (text.isascii() or not _BEYOND.search(text)):
            text = text.lower()  # of these characters, changes nothing but finds known words
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


_IDS: dict[str, Ids] = {}  # of this worker


def tokenized(docs: DataFrame, tokenizer: Callable[[], str], windows: tuple[int, ...], end_id: int) -> DataFrame:
    """(doc_id, ids, tier, tokens, before, part): each document's ids, its tier, and the tokens of that tier that its scan task has counted before it."""
    sizes = sorted(windows)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer()
        if path not in _IDS:
            _IDS[path] = Ids(path)
        ids, end = _IDS[path], end_id.to_bytes(4, "little")
        counted = dict.fromkeys(sizes, 0)
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):  # few texts' ids at once
            data, tiers, tokens, before = [], [], [], []
            for text in batch.column("text"):
                data.append(ids.of(text.as_py()) + end)
                tokens.append(len(data[-1]) // 4)
                tiers.append(next((w for w in sizes if w >= tokens[-1]), sizes[-1]))
                before.append(counted[tiers[-1]])
                counted[tiers[-1]] += tokens[-1]
            arrays = [batch.column("doc_id"), pa.array(data, pa.binary()), pa.array(tiers, pa.int32()), pa.array(tokens, pa.int64()), pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "tier", "tokens", "before"])

    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), F.coalesce(column("text"), F.lit("")).alias("text"))
    return in_arrow(narrow, step, "doc_id long, ids binary, tier int, tokens long, before long").withColumn("part", F.spark_partition_id())


@dataclass(frozen=True)
class Region:
    """Part of the line that is cut into windows of one size; the last one of all may be short of tokens."""

    begin: int
    end: int
    window: int
    first_sequence: int
    first_step: int


def regions(totals: dict[int, int], windows: tuple[int, ...] = WINDOWS, step: int = STEP) -> list[Region]:
    """The line's regions from the tokens of each tier: the tiers from the longest to the shortest, each up to the end of its last window.

    A step group holds sequences of one size, and as many of them as hold ``step`` of the largest windows.
    """
    out, at, line, sequence, group = [], 0, 0, 0, 0
    for w in sorted(windows, reverse=True):
        line += totals.get(w, 0)
        n = max(0, -(-(line - at) // w))
        if n:
            out.append(Region(at, at + n * w, w, sequence, group))
            at, sequence, group = at + n * w, sequence + n, group - (-n // (step * max(windows) // w))
    return out


def cut(place: int, tokens: int, line: list[Region], whole: int, largest: int, step: int) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """(start, length, sequence, offset, used, window, step) of the pieces of a document that begins at ``place``; ``whole`` is the line's length."""
    start = 0
    while start < tokens:
        at = place + start
        region = next(r for r in line if at < r.end)
        nth, offset = divmod(at - region.begin, region.window)
        length = min(tokens - start, region.window - offset)
        used = min(region.window, whole - (at - offset))
        yield start, length, region.first_sequence + nth, offset, used, region.window, region.first_step + nth // (step * largest // region.window)
        start += length


def pack(docs: DataFrame, tokenizer: Callable[[], str], windows: tuple[int, ...] = WINDOWS, end_id: int = 2, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, used, window, step_id.

    A document's ids are the tokenizer's, without added tokens, then ``end_id``; a null text counts as empty, so it is
    a piece of that one id.  start counts the document's ids before the piece, offset the sequence's ids before it.  window is the sequence's size and used what it
    holds, which is less for the last sequence of all only.  A step group (``step_id``) holds sequences of one size, and all groups the same number of
    tokens, but for the last of each size.  A document is cut where a window ends: once at most if the largest window holds it.
    Repeated rows and rows with a null doc_id are packed like any other.  An empty table gives an empty result; other columns are
    ignored.
    """
    found = materialize(tokenized(docs, tokenizer, windows, end_id), "ids")
    sums = found.groupBy("tier", "part").agg(F.sum("tokens").alias("tokens"))  # a row for each scan task and tier
    totals = {r["tier"]: r["tokens"] for r in sums.groupBy("tier").agg(F.sum("tokens").alias("tokens")).collect()}
    line, whole, largest = regions(totals, windows, step), sum(totals.values()), max(windows)
    earlier = Window.orderBy(F.desc("tier"), "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("tier", "part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    # A few numbers for each scan task; without the hint the ids would be shuffled before that is known.
    placed = found.join(F.broadcast(bases), ["tier", "part"]).select("doc_id", "ids", "tokens", (F.col("base") + F.col("before")).alias("place"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "used", "window", "step_id"]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids, tokens, place in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("tokens").to_pylist(), batch.column("place").to_pylist(), strict=True):
                data = memoryview(ids.as_buffer())
                for start, length, sequence, offset, used, window, group in cut(place, tokens, line, whole, largest, step):
                    out.append((doc_id, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), tokens, sequence, offset, used, window, group))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "window" else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)

    return in_arrow(placed, pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, used long, window int, step_id long")
