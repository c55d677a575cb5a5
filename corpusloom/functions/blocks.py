"""Rows of about the same size in blocks, and the pairs of rows of two blocks that may be similar.

A block is one row of a table: the ords, sizes, parities and tokens of some rows.  Spark pairs the blocks whose sizes are close enough, and a task decides all
pairs of rows of two blocks with all that either row has, so no pair travels before it has passed every bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import ship_package
from corpusloom.functions.grams import MOST_PARITIES, TEXTS, gram_hashes, parities, slot_counts

BLOCK_ROWS = 2048
BLOCK_BYTES = 4 << 20
WIDER = 8  # so many times as much is in a block whose rows are found by their tokens
STRIP = 512  # rows of a block that are compared at once with another block's
SLOTS = 4096  # slots of parities that are compared at once
MET = 1 << 21  # pairs of equal tokens that a task holds
LOOSE = 0.75  # below this threshold so many differences are allowed that parities have to tell more of them, and filled slots tell most at less cost
UNRELATED = 0.3  # at most so much of a set is in an unrelated one, as a rule
_NO_CUT = np.iinfo(np.int64).min

_ROW = {"ord": pa.int64(), "size": pa.int64(), "cut": pa.int64(), "parity": pa.binary(), "filled": pa.binary(), "tokens": pa.binary()}
ROW_SQL = "ord bigint, size bigint, cut bigint, parity binary, filled binary, tokens binary"
_BLOCK = {c: pa.int64() for c in ("n", "smallest", "largest", "first", "last")} | {c: pa.binary() for c in ("ords", "sizes", "cuts", "counts", "parities", "filled", "tokens")}
BLOCK_SQL = ", ".join(f"{c} {'bigint' if t == pa.int64() else 'binary'}" for c, t in _BLOCK.items())


class ParityBounds:
    """No tokens: all rows of similar size meet, and their parities decide."""

    counted = indexed = joined = False

    def __init__(self, threshold: float):
        self.t = threshold

    def tokens(self, grams: np.ndarray) -> np.ndarray:
        return grams[:0]


def block_rows(rows: DataFrame, n: int, tokens_of) -> DataFrame:
    """(ord, gram_text) -> rows (ord, size, cut, parity, filled, tokens).

    ``filled`` are hashed slots that hold a member, only for low thresholds at which all rows are compared.

    32 bits of a token are kept: two that agree there are one, which can only make rows share more than they do.  ``cut`` is the ord up to which a row has met the
    earlier ones, null for none.  Rows without ord are left out.
    """

    loose = tokens_of.t < LOOSE
    shape = (4, 4 * MOST_PARITIES) if loose else (2, MOST_PARITIES)
    compared = loose and not tokens_of.joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            out: dict[str, list] = {c: [] for c in _ROW}
            for ord_, text in zip(batch.column("ord").to_pylist(), batch.column("gram_text").to_pylist(), strict=True):
                if ord_ is None:
                    continue
                grams = gram_hashes(text, n)
                kept = (tokens_of.tokens(grams) >> np.uint64(32)).astype(np.uint32).tobytes()
                filled = np.packbits(slot_counts(grams) > 0).tobytes() if compared else b""
                for c, value in zip(_ROW, (ord_, len(grams), None, parities(grams, *shape), filled, kept), strict=True):
                    out[c].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in _ROW.items()], names=list(_ROW))

    return ship_package(rows).select("ord", "gram_text").mapInArrow(run, ROW_SQL)


def packed(rows: DataFrame, tokens_of) -> DataFrame:
    """Blocks of rows as they come, which should be sorted by size; a block's parities have one length, and its rows are in the order of ``ord``."""

    most_rows, most_bytes = (most * (WIDER if tokens_of.joined else 1) for most in (BLOCK_ROWS, BLOCK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        n_bytes = 0

        def block() -> pa.RecordBatch:
            held.sort(key=lambda r: r["ord"])
            sizes = np.array([r["size"] for r in held], np.int64)
            out = {
                "n": len(held), "smallest": int(sizes.min()), "largest": int(sizes.max()), "first": held[0]["ord"], "last": held[-1]["ord"],
                "ords": np.array([r["ord"] for r in held], np.int64).tobytes(), "sizes": sizes.tobytes(),
                "cuts": np.array([_NO_CUT if r["cut"] is None else r["cut"] for r in held], np.int64).tobytes(),
                "counts": np.array([len(r["tokens"]) // 4 for r in held], np.int64).tobytes(),
            } | {c: b"".join(r[k] for r in held) for c, k in (("parities", "parity"), ("filled", "filled"), ("tokens", "tokens"))}
            return pa.RecordBatch.from_arrays([pa.array([out[c]], t) for c, t in _BLOCK.items()], names=list(_BLOCK))

        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            for row in batch.to_pylist():
                if held and (len(held) >= most_rows or n_bytes >= most_bytes or len(row["parity"]) != len(held[0]["parity"])):
                    yield block()
                    held, n_bytes = [], 0
                held.append(row)
                n_bytes += len(row["parity"]) + len(row["filled"]) + len(row["tokens"])
        if held:
            yield block()

    return ship_package(rows).select(*_ROW).mapInArrow(run, BLOCK_SQL)


class _Block:
    """A block's columns as arrays."""

    def __init__(self, block: dict):
        n = block["n"]
        self.ords, self.sizes, self.cuts, self.counts = (np.frombuffer(block[c], np.int64) for c in ("ords", "sizes", "cuts", "counts"))
        self.smallest, self.largest = block["smallest"], block["largest"]
        self.parities = np.frombuffer(block["parities"], np.uint8).reshape(n, -1)
        self.filled = np.frombuffer(block.get("filled", b""), np.uint8).reshape(n, -1)
        self.tokens = np.frombuffer(block["tokens"], np.uint32)
        self.starts = np.r_[0, np.cumsum(self.counts)]
        self._folds: dict[int, np.ndarray] = {}
        self._filled: dict[int, np.ndarray] = {}
        self._postings: tuple[np.ndarray, np.ndarray] | None = None

    def folded(self, width: int) -> np.ndarray:
        """The parities in ``width`` bytes each, as words."""
        if width not in self._folds:
            n, whole = self.parities.shape
            self._folds[width] = np.bitwise_xor.reduce(self.parities.reshape(n, whole // width, width), axis=1).view(np.uint64)
        return self._folds[width]

    def filled_in(self, width: int) -> np.ndarray:
        """The filled slots in ``width`` bytes each, as words."""
        if width not in self._filled:
            n, whole = self.filled.shape
            self._filled[width] = np.bitwise_or.reduce(self.filled.reshape(n, whole // width, width), axis=1).view(np.uint64)
        return self._filled[width]

    @property
    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted tokens and the rows that have them."""
        if self._postings is None:
            every = np.sort(self.tokens.astype(np.uint64) << np.uint64(32) | np.repeat(np.arange(len(self.ords), dtype=np.uint64), self.counts))
            self._postings = (every >> np.uint64(32)).astype(np.uint32), every.astype(np.uint32).astype(np.int64)
        return self._postings


def unpacked(blocks: DataFrame) -> DataFrame:
    """The rows of blocks; their cuts are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1) for b in batches for at in range(b.num_rows)):
            block = _Block(batch.to_pylist()[0])
            ends = block.starts.tolist()
            tokens = [block.tokens[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            columns = [block.ords, block.sizes, [None] * len(ends[1:]), [p.tobytes() for p in block.parities], [f.tobytes() for f in block.filled], tokens]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, _ROW.values(), strict=True)], names=list(_ROW))

    return ship_package(blocks).select(*_BLOCK).mapInArrow(run, ROW_SQL)


def _meeting(left: _Block, right: _Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of left and right rows that share a token, in order, those of some left rows at a time."""
    tokens, theirs = right.postings
    own, mine = left.postings
    first = np.searchsorted(tokens, own, "left")
    many = np.searchsorted(tokens, own, "right") - first
    hit = np.flatnonzero(many)
    hit = hit[np.argsort(mine[hit], kind="stable")]
    mine, first, many = mine[hit], first[hit], many[hit]
    rows, begins = np.unique(mine, return_index=True)
    if not len(rows):
        return
    ends, n = np.r_[begins[1:], len(mine)], len(right.ords)
    totals = np.add.reduceat(many, begins)
    at = 0
    while at < len(rows):
        if totals[at] > n:  # a family of near copies, which share many
            met = np.zeros(n, bool)
            for a, k in zip(first[begins[at] : ends[at]].tolist(), many[begins[at] : ends[at]].tolist(), strict=True):
                met[theirs[a : a + k]] = True
            found = np.flatnonzero(met)
            yield np.full(len(found), rows[at]), found
            at += 1
            continue
        sums = np.cumsum(np.where(totals[at:] > n, MET + 1, totals[at:]))
        to = at + max(1, int(np.searchsorted(sums, MET, "right")))
        some = slice(begins[at], ends[to - 1])
        m, before = many[some], np.cumsum(many[some]) - many[some]
        codes = np.repeat(mine[some] * n, m) + theirs[np.repeat(first[some] - before, m) + np.arange(m.sum())]
        codes = np.sort(codes)
        codes = codes[np.r_[True, codes[1:] != codes[:-1]]]
        yield codes // n, codes % n
        at = to


def _enough(most: float, apart: float, whole: int) -> tuple[int, int]:
    """(bytes to fold parities to, words of them to compare): the fewest that tell sets which differ in ``apart`` members from those that differ in ``most``.

    Slots in which folded parities differ, or some words of them, are never more than the members in which the sets do.
    """
    for width in (8 << k for k in range(13)):
        if width >= whole:
            break
        slots = 8 * width
        share = (1 - np.exp(-2 * max(apart, 1) / slots)) / 2
        words = int(np.ceil((most + 4 * np.sqrt(most) + 1) / share / 64))
        if 8 * words <= width:
            return width, words
    return whole, whole // 8


def _enough_filled(t: float, small: _Block, large: _Block, whole: int) -> tuple[int, int]:
    """As ``_enough`` for slots that a set of the small block fills and one of the large block doesn't: never more than members that the former has alone."""
    most = max((small.largest - t * large.smallest) / (1 + t), 0)
    best = whole, whole // 8
    for width in (8 << k for k in range(14)):
        if width > whole:
            break
        slots = 8 * width
        share = (1 - np.exp(-(1 - UNRELATED) * max(small.smallest, 1) / slots)) * np.exp(-large.largest / slots)
        words = int(np.ceil(min((most + 4 * np.sqrt(most) + 1) / max(share, 1e-9) / 64, 1 << 30)))
        if 8 * words <= width and words < best[1]:
            best = width, words
    return best


def _bits(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1).astype(np.float32)


def _compared(tokens_of, left: _Block, right: _Block, after: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of left and right rows in ``after`` to ``before`` whose slots may allow for the similarity, in order, those of some left rows at a time.

    Slots that are odd in both rows, or filled in both, are counted for all pairs at once, by a product of matrices.  All numbers are whole halves and small, so
    that 32 bits hold them exactly.  Unrelated sets differ in two thirds of their members or more as a rule; what isn't told by as many words as that takes passes.
    """
    t = tokens_of.t
    rate = (1 - t) / (1 + t)
    if t < LOOSE:
        # Pairs pass if filled(small) - filled(both) <= size(small) - shared members, and these are t / (1 + t) of both sizes at least.
        smaller = 0 if left.sizes.mean() <= right.sizes.mean() else 1
        width, some = _enough_filled(t, *((right, left) if smaller else (left, right)), min(left.filled.shape[1], right.filled.shape[1]))
        mine, theirs = left.filled_in(width)[:, :some], right.filled_in(width)[:, :some]
        full = np.bitwise_count((mine, theirs)[smaller]).sum(axis=1, dtype=np.int64)
        least = [full - b.sizes / (1 + t) if side == smaller else t / (1 + t) * b.sizes for side, b in enumerate((left, right))]
        least = [(np.floor(2 * v - 1e-6) / 2).astype(np.float32) for v in least]
    else:
        # Pairs pass if odd(left) + odd(right) - 2 * odd(both) <= rate * (size(left) + size(right)).
        whole = min(left.parities.shape[1], right.parities.shape[1])
        width, some = _enough(rate * (left.largest + right.largest), (left.smallest + right.smallest) * 2 / 3, whole)
        mine, theirs = left.folded(width)[:, :some], right.folded(width)[:, :some]
        least = [np.floor(np.bitwise_count(w).sum(axis=1, dtype=np.int64) - rate * b.sizes - 1e-6).astype(np.float32) / 2 for w, b in ((mine, left), (theirs, right))]
    strips = [slice(i, min(i + STRIP, len(left.ords))) for i in range(0, len(left.ords), STRIP)]
    # Rows of both blocks are in the order of ord, so a strip's rows meet one range.
    reach = [(int(after[s].min()), int(before[s].max())) for s in strips]
    strips, reach = zip(*[(s, r) for s, r in zip(strips, reach, strict=True) if r[0] < r[1]], strict=True) if any(a < b for a, b in reach) else ((), ())
    both: list[np.ndarray] = []
    for k in range(0, some, SLOTS // 64):
        l_bits, r_bits = _bits(mine[:, k : k + SLOTS // 64]), _bits(theirs[:, k : k + SLOTS // 64])
        for at, (s, (begin, end)) in enumerate(zip(strips, reach, strict=True)):
            product = l_bits[s] @ r_bits[begin:end].T
            if k:
                both[at] += product
            else:
                both.append(product)
    for s, (begin, end), counts in zip(strips, reach, both, strict=True):
        counts -= least[0][s, None]
        i, j = np.nonzero(counts >= least[1][begin:end])
        yield i + s.start, j + begin


def _alike_enough(t: float, left: _Block, right: _Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows their parities, all of them, allow to be similar."""
    whole = min(left.parities.shape[1], right.parities.shape[1])
    differ = np.bitwise_count(left.folded(whole)[i] ^ right.folded(whole)[j]).sum(axis=1, dtype=np.int64)
    return differ <= (1 - t) / (1 + t) * (left.sizes[i] + right.sizes[j]) + 1e-6


def _shares(tokens_of, left: _Block, right: _Block, i: int, j: int) -> bool:
    """Whether two rows share as many tokens as their sizes call for."""
    seen = np.isin(left.tokens[left.starts[i] : left.starts[i + 1]], right.tokens[right.starts[j] : right.starts[j + 1]]).sum()
    return seen >= tokens_of.shared(left.sizes[i], left.counts[i], right.sizes[j], right.counts[j])


def _near(tokens_of, left: _Block, right: _Block, heads: int) -> Iterator[tuple[int, np.ndarray, int | None]]:
    """(ord, earlier ords, cut) of left rows: the first ``heads`` right rows that may be similar; if there are more, the ord up to which they are all."""
    t = tokens_of.t
    before = np.searchsorted(right.ords, left.ords, "left")
    after = np.where(left.cuts == _NO_CUT, 0, np.searchsorted(right.ords, left.cuts, "right"))
    at_once = max(1, BLOCK_BYTES // left.parities.shape[1])
    for i, j in _meeting(left, right) if tokens_of.joined else _compared(tokens_of, left, right, after, before):
        a, b = left.sizes[i], right.sizes[j]
        fits = np.flatnonzero((j >= after[i]) & (j < before[i]) & (np.minimum(a, b) >= t * np.maximum(a, b) - 1e-6))
        if not len(fits):
            continue
        i, j = i[fits], j[fits]
        fits = np.concatenate([_alike_enough(t, left, right, i[k : k + at_once], j[k : k + at_once]) for k in range(0, len(i), at_once)])
        i, j = i[fits], j[fits]
        for begin, end in zip(*(np.searchsorted(i, np.unique(i), side).tolist() for side in ("left", "right")), strict=True):
            row, found = int(i[begin]), j[begin:end]
            if tokens_of.indexed and not tokens_of.joined:
                found = np.array(list(islice((k for k in found.tolist() if _shares(tokens_of, left, right, row, k)), heads + 1)), np.int64)
            cut = None
            if len(found) > heads:
                cut = int(right.ords[found[heads]]) - 1
                found = found[:heads]
                found = found[right.ords[found] <= cut]
            if len(found) or cut is not None:
                yield int(left.ords[row]), right.ords[found], cut


def near_pairs(left: DataFrame, right: DataFrame, tokens_of, heads: int) -> DataFrame:
    """(lo, hi, cut): pairs of a left row and an earlier right one behind the left row's cut that may be similar, and for rows with more than ``heads`` of them in
    a right block the ord up to which they are all here (lo is null).

    Blocks meet without being shuffled: a task reads some blocks of either side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in (b.slice(k, 1) for b in batches for k in range(b.num_rows)):
            both = batch.to_pylist()[0]
            if own is None or both["l"]["ords"] != at:
                at, own = both["l"]["ords"], _Block(both["l"])
            los, his, cuts = [], [], []
            for hi, earlier, cut in _near(tokens_of, own, _Block(both["r"]), heads):
                los += earlier.tolist()
                his += [hi] * len(earlier)
                cuts += [None] * len(earlier)
                if cut is not None:
                    los, his, cuts = [*los, None], [*his, hi], [*cuts, cut]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (los, his, cuts)], names=["lo", "hi", "cut"])

    t = F.lit(float(tokens_of.t) - 1e-9)
    a, b = (side.select(F.struct(*_BLOCK).alias(name)) for side, name in ((left, "l"), (right, "r")))
    close = (F.col("r.largest") >= t * F.col("l.smallest") - 1) & (F.col("l.largest") >= t * F.col("r.smallest") - 1) & (F.col("r.first") < F.col("l.last"))
    pairs = a.join(b.hint("shuffle_replicate_nl"), close)
    return ship_package(pairs).mapInArrow(run, "lo bigint, hi bigint, cut bigint")
