"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

A piece of text starts as one symbol per byte.  The adjacent pair of lowest rank (the leftmost of equals) is popped from
a heap and merged in the linked list until no pair has a rank; the count is the number of symbols minus the merges.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.cache import TwoGenerations
from corpusloom.llm.rows import column, in_arrow

# Fixed value: how byte-level BPE of this family splits text before merging.  White space is Unicode's White_Space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
_ENDS = tuple(".,;:!?")
_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER_SPACE = regex.compile(r"[^\S \n]")
CACHED = 400_000  # chunks of text in each of a worker's two generations of known counts
_CACHED_LENGTH = 64  # longer chunks are counted each time


def byte_symbols() -> dict[str, int]:
    """The characters that stand for the 256 bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


_PLACE = (1 << 32) - 1


def merge_count(data: bytes, merges: dict[int, int], made: list[int]) -> int:
    """How many tokens ``data`` becomes.

    merges: left << 20 | right -> rank, where symbols below 256 are bytes; made: rank -> symbol.
    """
    size = len(data)
    symbols, rank_of, heap = [*data, -1], merges.get, []
    left = -1
    for i, right in enumerate(data):
        if (rank := rank_of(left << 20 | right)) is not None:
            heap.append(rank << 32 | i - 1)
        left = right
    if not heap:
        return size
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    after, before = list(range(1, size + 1)), list(range(-1, size))
    merged = 0
    while heap:
        top = pop(heap)
        rank, i = top >> 32, top & _PLACE
        j = after[i]
        if rank_of(symbols[i] << 20 | symbols[j]) != rank:
            continue  # one of the two has been merged since, or is gone (-1 makes no pair)
        symbol = symbols[i] = made[rank]
        symbols[j] = -1
        merged += 1
        after[i] = k = after[j]
        before[k] = i
        if (right := rank_of(symbol << 20 | symbols[k])) is not None:
            push(heap, right << 32 | i)
        if (h := before[i]) >= 0 and (left := rank_of(symbols[h] << 20 | symbol)) is not None:
            push(heap, left << 32 | h)
    return size - merged


class Counter:
    """Counts the tokens of texts by the rules of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        numbers = {name: 256 + n for n, name in enumerate(x for x in spec["model"]["vocab"] if x not in symbols)} | symbols
        self.merges, self.made = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(numbers[left] << 20 | numbers[right], rank)
            self.made.append(numbers[left + right])
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.pieces = regex.compile(PIECES)
        self.known = TwoGenerations(self.chunk, CACHED, _CACHED_LENGTH)

    def chunk(self, text: str) -> int:
        """The count of a text without special strings."""
        if text[-1:] in _ENDS and text[-2:-1].isalpha():
            return self.known[text[:-1]] + 1  # the mark is a piece and a byte of its own
        pieces = [text] if text.isalpha() or text[:1] == " " and text[1:].isalpha() else self.pieces.findall(text)
        return sum([merge_count(piece.encode(), self.merges, self.made) for piece in pieces])

    def plain(self, text: str) -> int:
        """As ``chunk``, from known counts: a text may be cut before a single space between other characters."""
        known = self.known
        if "\0" in text or any(run in text for run in _RUNS) or _OTHER_SPACE.search(text):
            first, *rest = _CUT.split(text)
            return known[first] + sum(map(known.__getitem__, [" " + w for w in rest]))
        # Only single spaces and line feeds: a space goes with the word behind it, a line feed stands alone.
        return sum(map(known.__getitem__, text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")))

    def count(self, text: str) -> int:
        """Tokens of a whole text; each special string is one."""
        if self.special is None or not any(m in text for m in self.marks):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


_COUNTERS: dict[str, Counter] = {}  # of this worker


def count_tokens(docs: DataFrame, tokenizer: Callable[[], str], limit: int = 1024) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` gives the place of a byte-level BPE file on a worker.  Whole texts are counted without begin, end or added tokens; special strings
    inside of a text are one token each.  A null or empty text has 0 bytes and tokens.  Repeated rows are counted alike; an empty table gives an
    empty result; other columns are ignored.  A worker keeps counts of recent chunks in two bounded generations.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer()
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(column("text"), F.lit(""))
    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = in_arrow(narrow, step, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
