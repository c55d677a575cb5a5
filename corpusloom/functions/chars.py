"""Counts of characters and tokens of whole texts, from one look at each character's classes.

A regular expression per count reads a text anew each time, at some 30 nanoseconds a character.  Here Spark hands the texts of a partition over in Arrow
batches, and a worker looks the characters of a few texts at a time up in a table of classes.  The table comes from the patterns themselves, as Spark's own
regular expressions see them, so both mean the same on every Java and Python release.
"""

from __future__ import annotations

import zlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import patterns as P

SPACE, CJK, LETTER, DIGIT_VALUED, SYMBOL, ALNUM, DECIMAL, WORD = (1 << i for i in range(8))
TEXTS = 256  # whose characters a task holds at once
_SURROGATES = range(0xD800, 0xE000)
_COUNTED = {"visible": SPACE, "zh": CJK, "letters": LETTER, "digits": DIGIT_VALUED, "symbols": SYMBOL, "alnum": ALNUM}
CHAR_COUNTERS = [*_COUNTED, "distinct", "keywords", "max_run"]
_KEYWORD_CHARS = max(map(len, P.CODE_KEYWORDS))
_KEYWORDS = np.unique([int.from_bytes(k.encode().ljust(_KEYWORD_CHARS, b"\0"), "big") for k in P.CODE_KEYWORDS])


@lru_cache(maxsize=None)
def _asked(_: str, spark: SparkSession) -> bytes:
    patterns = {SPACE: P.WS, CJK: f"[{P.CJK_RANGE}]", LETTER: "[A-Za-z]", DIGIT_VALUED: P.digit_class(), SYMBOL: P.CODE_SYMBOL_CLASS, ALNUM: P.ALNUM, DECIMAL: P.DIGIT, WORD: P.WORD}
    codes = spark.range(0x110000, numPartitions=1).filter(~F.col("id").between(_SURROGATES[0], _SURROGATES[-1]))
    chars = codes.select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    found = chars.select("id", reduce(Column.__add__, [F.when(F.col("c").rlike(p), bit).otherwise(0) for bit, p in patterns.items()]).alias("classes"))
    rows = found.filter("classes > 0").toArrow()
    table = np.zeros(0x110000, np.uint8)
    table[rows["id"].to_numpy()] = rows["classes"].to_numpy()
    return zlib.compress(table.tobytes())


def classes_of(spark: SparkSession) -> bytes:
    """The classes of every code point, a byte each (compressed); asked once per application."""
    return _asked(spark.sparkContext.applicationId, spark)


@lru_cache(maxsize=1)
def _table(classes: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(classes), np.uint8)


class _Texts:
    """The characters of some texts, each with a line end behind it, so that no text is empty or touches the next one."""

    def __init__(self, texts: list[str], classes: bytes):
        lengths = np.array([len(t) for t in texts], np.int64) + 1
        self.starts = np.cumsum(lengths) - lengths
        self.ends = self.starts + lengths - 1
        self.points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le"), "<u4")
        self.classes = _table(classes)[self.points]

    def are(self, bit: int) -> np.ndarray:
        return (self.classes & bit) != 0

    def sums(self, marks: np.ndarray) -> np.ndarray:
        return np.add.reduceat(marks, self.starts, dtype=np.int64)


def _longest_runs(t: _Texts) -> np.ndarray:
    """Of one character; blanks count as one each, and so does any character of a text that isn't empty."""
    longest = (t.ends > t.starts).astype(np.int64)
    again = np.flatnonzero((t.points[1:] == t.points[:-1]) & ~t.are(SPACE)[1:])
    if len(again):
        first = np.flatnonzero(np.r_[True, np.diff(again) != 1])
        lengths = np.diff(np.r_[first, len(again)]) + 1
        np.maximum.at(longest, np.searchsorted(t.starts, again[first], side="right") - 1, lengths)
    return longest


def _keywords(t: _Texts) -> np.ndarray:
    """Words (runs of letters, numbers and underscores) that are keywords."""
    words = t.are(WORD)
    edges = np.flatnonzero(words[1:] != words[:-1]) + 1
    edges = (np.r_[0, edges] if words[0] else edges).reshape(-1, 2)  # the last character is a line end
    edges = edges[edges[:, 1] - edges[:, 0] <= _KEYWORD_CHARS]
    starts, lengths = edges[:, 0], edges[:, 1] - edges[:, 0]
    packed, plain = np.zeros(len(starts), np.int64), np.ones(len(starts), bool)
    for k in range(_KEYWORD_CHARS):
        char = np.where(k < lengths, t.points[np.minimum(starts + k, len(t.points) - 1)], 0)
        plain &= char < 128
        packed = (packed << 8) + np.where(plain, char, 0)
    found = starts[plain & np.isin(packed, _KEYWORDS)]
    return np.bincount(np.searchsorted(t.starts, found, side="right") - 1, minlength=len(t.starts))


def _char_counts(texts: list[str], classes: bytes) -> dict[str, np.ndarray]:
    t = _Texts(texts, classes)
    blanks = frozenset(P.WS_CHARS)
    counts = {name: t.sums(~t.are(bit) if bit == SPACE else t.are(bit)) for name, bit in _COUNTED.items()}
    return counts | {"distinct": np.array([len(set(x) - blanks) for x in texts], np.int64), "keywords": _keywords(t), "max_run": _longest_runs(t)}


def _joined(places: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which of the signs at these places join the runs before and behind them, going from left to right: a run that has been joined to the
    one before (the whole of it) can't be joined to the next one.  ``ends`` are the ends of the runs behind."""
    chained = np.r_[False, (places[1:] == ends[:-1]) & whole[:-1]]
    number = np.arange(len(places))
    return (number - np.maximum.accumulate(np.where(chained, 0, number))) % 2 == 0


def _token_counts(texts: list[str], classes: bytes) -> np.ndarray:
    """How many tokens the pattern ``TOKEN`` finds: all visible characters but those that go on with a token."""
    t = _Texts(texts, classes)
    starts = ~t.are(SPACE)
    letters, decimals = t.are(LETTER), t.are(DECIMAL)
    words = letters | (t.points == ord("_"))
    for run, behind, sign in ((words, letters, "'"), (decimals, decimals, ".")):
        starts[1:] &= ~(run[1:] & run[:-1])
        at = np.flatnonzero(t.points[1:-1] == ord(sign)) + 1
        at = at[run[at - 1] & behind[at + 1]]
        if not len(at):
            continue
        run_ends = np.flatnonzero(run[:-1] & ~run[1:]) + 1
        ends = run_ends[np.searchsorted(run_ends, at + 1, side="right")]
        # Behind an apostrophe there are letters only: an underscore in that run opens a token.
        others = np.r_[np.flatnonzero(run & ~behind), len(run)]
        opens = others[np.searchsorted(others, at)]
        joined = _joined(at, ends, opens >= ends)
        starts[at[joined]] = starts[at[joined] + 1] = False
        starts[opens[joined & (opens < ends)]] = True
    return t.sums(starts)


def _slices(texts: pa.Array) -> list[list[str]]:
    """Few at a time; what isn't UTF-8 is read as Java reads it, null as empty."""
    raw = texts.cast(pa.binary())
    return [[(x or b"").decode("utf-8", "replace") for x in raw.slice(at, TEXTS).to_pylist()] for at in range(0, len(raw), TEXTS)]


def char_counts(text: str, classes: bytes) -> Column:
    """A struct of ``CHAR_COUNTERS``, null for a null text."""

    def counted(texts: pa.Array) -> pa.Array:
        found = [_char_counts(some, classes) for some in _slices(texts)]
        columns = [pa.array(np.concatenate([np.empty(0, np.int64), *[f[c] for f in found]])) for c in CHAR_COUNTERS]
        return pa.StructArray.from_arrays(columns, names=CHAR_COUNTERS, mask=texts.is_null())

    return F.arrow_udf(counted, ", ".join(f"{c} bigint" for c in CHAR_COUNTERS))(F.col(text))


def token_count(text: str, classes: bytes) -> Column:
    """The number of tokens, null for a null text."""

    def counted(texts: pa.Array) -> pa.Array:
        found = [_token_counts(some, classes) for some in _slices(texts)]
        return pa.array(np.concatenate([np.empty(0, np.int64), *found]), pa.int64(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(counted, "bigint")(F.col(text))
