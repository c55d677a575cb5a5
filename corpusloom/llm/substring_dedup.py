"""Substring deduplication by runs of consecutive sentences that occur more than once in the corpus.

Every run of several consecutive sentences with enough words is hashed, and every run that isn't the first of its hash, in the order of
(doc_id, place), marks its sentences for removal.  A task sorts its own runs block by block first: a run that isn't the first of its block is settled, so
a hash sends one row per block to the task that compares the blocks, also if a third of the corpus shares it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.rows import as_row, column, in_arrow, text_key

MIN_WORDS = 25  # of a run
WHOLE = 12  # sentences of more words are cut, at words that the words around them choose
NEAR = 7  # so many words in a row hold a cut; WHOLE and NEAR leave MIN_WORDS of any 50 words between cuts that depend on nothing outside
BLOCK = 1 << 18  # runs that a task compares with each other

# Letters of scripts without spaces (Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han), each a word with the marks and signs behind it.
_LETTERS = "ก-໿ཀ-ྼက-႟ក-៿々-〇ぁ-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_LETTERS}。！？]")
_UNIT = regex.compile(rf"[{_LETTERS}][\p{{M}}\p{{P}}]*|(?:(?![{_LETTERS}\x1c-\x1f])\S)+")
_FULL_END = re.compile(r"(?<=[.!?])\s+|\n\s*|(?<=[。！？])(?![。！？])\s*")


@dataclass
class Parts:
    """A text cut without a gap: where each part begins, the words of the text up to there, and all words in lower case."""

    begins: np.ndarray
    words_before: np.ndarray  # one more than parts
    words: list[str]

    def hashes(self) -> list[int]:
        stops = self.words_before.tolist()
        return [xxhash.xxh3_64_intdigest(" ".join(self.words[a:b])) for a, b in zip(stops, stops[1:], strict=False)]


def parts(text: str) -> Parts:
    """The text's sentences; those of more than ``WHOLE`` words are cut at words chosen by their hashes.

    A sentence ends behind . ! or ? before white space, or at a line feed; white space goes with what is before it.  In a longer one a word begins a part if
    its hash is the smallest (of equal ones the last) of any ``NEAR`` words in a row.  Where a text is cut depends on less than ``NEAR`` words to each
    side, so any 50 words that two texts share, wherever they begin and end, hold the same cuts but for 12 words at the front and 13 at the
    back: at least ``MIN_WORDS`` words of them are a run.  A letter of a script without spaces is a word, and the full-width marks end a
    sentence without white space.
    """
    if not text.isascii() and _UNSPACED.search(text):
        ends = np.array([m.end() for m in _FULL_END.finditer(text)], np.int64)
        edges = [0, *ends.tolist(), len(text)]
        spans = [m.span() for a, b in zip(edges, edges[1:], strict=False) for m in _UNIT.finditer(text, a, b)]
        words = [text[a:b].lower() for a, b in spans]
        starts = np.array([a for a, _ in spans], np.int64)
    else:
        starts, ends = _spaced(text)
        words = text.lower().split()
    sentence = np.searchsorted(ends, starts, side="right")
    long = np.bincount(sentence, minlength=1) > WHOLE
    begins = [np.zeros(1, np.int64), ends]
    if long.any():
        marks = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in words], np.uint64)
        # The smallest of these is the smallest hash, and of equal ones the last.
        keys = (marks << np.uint64(32)) | np.arange(len(words), 0, -1, dtype=np.uint64)
        n = len(words) - NEAR + 1
        least = keys[:n]
        for k in range(1, NEAR):
            least = np.minimum(least, keys[k : k + n])
        within = (sentence[NEAR - 1 :] == sentence[:n]) & long[sentence[:n]]
        cuts = len(words) - (np.unique(least[within]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # A sentence's first word begins a part anyhow.
        begins.append(starts[cuts[np.append(True, sentence[1:] != sentence[:-1])[cuts] == 0]])
    begins = np.unique(np.concatenate(begins))
    begins = begins[begins < len(text)]
    return Parts(begins, np.append(np.searchsorted(starts, begins), len(words)), words)


_IS_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])  # no character above is white space


def _spaced(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where words and sentences begin, in a text whose words have white space between them."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _IS_SPACE[np.minimum(chars, 0x3000)] & (chars <= 0x3000)
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))[: len(chars)] if len(chars) else np.empty(0, np.int64)
    lines = np.append(0, np.cumsum(chars == ord("\n")))
    stops = np.flatnonzero(~space & np.append(space[1:], True)) + 1 if len(chars) else starts
    before = np.append(0, stops[:-1])[: len(starts)]  # where the white space before a word begins
    marked = np.isin(chars[before - 1], [ord(c) for c in ".!?"]) & (before > 0) if len(starts) else np.empty(0, bool)
    return starts, starts[marked | (lines[starts] > lines[before])]


def runs(words: np.ndarray, docs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of runs of two or more parts of one document with at least ``least`` words, in order: the shortest from each part on and up to each part.

    ``words`` are those of all parts up to each one, over all documents; ``docs`` is where each document's parts begin; both go on to the end.
    """
    n = docs[-1]
    at = np.arange(n)
    doc = np.searchsorted(docs, at, side="right") - 1
    last = np.maximum(np.searchsorted(words, words[:-1] + least, side="left") - 1, at + 1)
    fits = last < docs[doc + 1]
    forward = at[fits], last[fits]
    first = np.minimum(np.searchsorted(words, words[1:] - least, side="right") - 1, at - 1)
    fits = first >= docs[doc]
    fits[fits] = last[first[fits]] != at[fits]  # not again
    first, last = np.concatenate([forward[0], first[fits]]), np.concatenate([forward[1], at[fits]])
    order = np.lexsort((last, first))
    return first[order], last[order]


_BASE = 0x9E3779B97F4A7C17
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of parts: a polynomial over the parts' hashes, from sums up to each part, then mixed."""
    sums = np.append(np.uint64(0), np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64))
    value = (sums[last + 1] - sums[first]) * _powers(_INVERSE, len(hashes))[first] + (last - first).astype(np.uint64)
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


_RUN = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])
_NO_ID = -(1 << 63)  # sorts a null id first


def _later(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (key, doc_id, place): which aren't the same as the row before, and which of them aren't the first of their key."""
    key, ids, place = (pc.fill_null(rows.column(c), _NO_ID).to_numpy() for c in ("key", "doc_id", "place"))
    same_key = np.append(False, key[1:] == key[:-1])
    new = ~(same_key & np.append(False, (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])))
    return new, new & same_key


def _spans(docs: DataFrame, least: int) -> DataFrame:
    """(key, doc_id, place) of runs; place holds half of the document's key and, below, the run's number in the document.

    The first run of each hash in a block of documents has the hash as its key, an even number.  The others are settled: they aren't the first of their hash, and
    their keys are odd numbers that spread them.  This is all that is shuffled of a run.
    """

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids = pc.fill_null(rows.column("doc_id"), _NO_ID).to_numpy()
        order = np.lexsort((rows.column("place").to_numpy(), ids, rows.column("key").to_numpy()))
        rows = rows.take(pa.array(order)).combine_chunks().to_batches()[0]
        new, later = _later(rows)
        keys, places = rows.column("key").to_numpy(), rows.column("place").to_numpy()
        spread = (keys.view(np.uint64) + places.view(np.uint64)) * np.uint64(_BASE) | np.uint64(1)
        keys = np.where(later, spread.view(np.int64), keys)
        return pa.RecordBatch.from_arrays([pa.array(keys), *rows.columns[1:]], schema=_RUN).filter(pa.array(new))

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, words, sizes, n_words = [], [np.zeros(1, np.int64)], [0], 0
        for text in batch.column("text"):
            cut = parts(text.as_py())
            hashes += cut.hashes()
            words.append(cut.words_before[1:] + n_words)
            n_words += len(cut.words)
            sizes.append(len(cut.begins))
        starts = np.cumsum(sizes)
        first, last = runs(np.concatenate(words), starts, least)
        doc = np.searchsorted(starts, first, side="right") - 1
        number = np.arange(len(doc)) - np.searchsorted(doc, np.arange(batch.num_rows))[doc]
        place = (batch.column("half").to_numpy()[doc] << 32) + number
        keys = run_hashes(np.array(hashes, np.uint64), first, last) & ~np.uint64(1)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("doc_id").take(pa.array(doc)), pa.array(place)], schema=_RUN)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # few texts at once
                held.append(found(batch.slice(start, 256)))
                n += held[-1].num_rows
                if n >= BLOCK:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return in_arrow(docs.filter("text IS NOT NULL"), step, "key long, doc_id long, place long")


def _not_first(spans: DataFrame) -> DataFrame:
    """(doc_id, place) of the runs whose hash stands earlier in the order of (doc_id, place); repeats of a document count once."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row so far
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            later = _later(rows)[1][0 if before is None else 1 :]
            settled = (batch.column("key").to_numpy() & 1).astype(bool)
            before = batch.slice(batch.num_rows - 1)
            yield batch.filter(pa.array(later | settled)).select(["doc_id", "place"])

    return in_arrow(spans.repartition("key").sortWithinPartitions("key", "doc_id", "place"), step, "doc_id long, place long")


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, half, numbers): for documents with repeated runs, the numbers of the runs that aren't the first of their hash.

    half is the upper half of the document's text key; a document has at most two runs for each of its parts.
    """
    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), F.shiftright(text_key(column("text")), 32).alias("half"), column("text").alias("text"))
    found = _not_first(_spans(narrow, least))
    number = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    return found.groupBy("doc_id", F.shiftright("place", 32).alias("half")).agg(F.collect_set(number).alias("numbers"))


def without(text: str, numbers: list[int], least: int) -> tuple[str, int, int]:
    """The text without the runs of these numbers, how many parts there were and how many went."""
    cut = parts(text)
    n = len(cut.begins)
    first, last = runs(cut.words_before, np.array([0, n]), least)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, first[numbers], 1)
    np.add.at(edges, last[numbers] + 1, -1)
    gone = np.cumsum(edges)[:n] > 0
    stops = [*cut.begins.tolist(), len(text)]
    return "".join(text[a:b] for a, b, g in zip(stops, stops[1:], gone.tolist(), strict=False) if not g), n, int(gone.sum())


def drop_repeated_sentences(docs: DataFrame, least: int = MIN_WORDS, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with new texts: sentences covered by a repeated run that isn't the run's first are removed.

    A run is two or more consecutive sentences, or parts of long ones (``parts``), with at least ``least`` words, compared without regard to case and white space; it
    is the shortest such from its first part on, or up to its last.  The first of equal runs is that with the smallest (doc_id, half of the text key, place);
    null ids come first.  All other columns and all rows stay, also rows whose text becomes empty; a text without repeated
    runs, and a null text, stays as it is.  Repeated rows (equal doc_id and text) count as one document and all get its
    text.  An empty table gives an empty result.  ``counts`` names two columns to add: parts, and parts removed (null if
    nothing was found).
    """
    found = repeated_runs(docs, least)
    found = found.select(F.col("doc_id").alias("its_id"), F.col("half").alias("its_half"), "numbers")
    rows = docs.select(as_row(docs.drop("text")), column("text").alias("text"), column("doc_id").cast("long").alias("doc_id"), F.shiftright(text_key(column("text")), 32).alias("half"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("half") == F.col("its_half")), "left").select("row", "text", "numbers")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed = [], [], []
            for text, numbers in zip(batch.column("text"), batch.column("numbers"), strict=True):
                new, n, k = (text.as_py(), None, None) if not numbers.is_valid else without(text.as_py(), numbers.as_py(), least)
                texts.append(new)
                totals.append(n)
                removed.append(k)
            arrays = [batch.column("row"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "text", "total", "removed"])

    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("total", T.LongType()), T.StructField("removed", T.LongType())])
    done = in_arrow(joined, step, schema)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if counts:
        columns += [F.col("total").alias(counts[0]), F.col("removed").alias(counts[1])]
    return done.select(*columns)
