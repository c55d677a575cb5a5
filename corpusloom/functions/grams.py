"""Character n-gram sets as sorted 64-bit hashes, the per-row sketches that near-duplicate search needs, and the rows that meet at a token.

The classes here turn one text into one small array; Spark partitions the rows and calls them batch by
batch through :func:`gram_sets`, :func:`gram_counts`, :func:`sketches`, :func:`meetings` and :func:`counted_pairs`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.frames import ship_package

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser: spreads every input bit over all 64 output bits."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(count: int, stream: int) -> np.ndarray:
    """Reproducible odd 64-bit multipliers."""
    return mix(np.arange(count, dtype=np.uint64) + np.uint64(stream << 32)) | np.uint64(1)


@cache
def _gram_factors(n: int) -> np.ndarray:
    return odd_multipliers(n, 1)


def gram_hashes(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the character n-grams; a text of at most n characters is one gram."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    width = min(n, len(points))
    starts = len(points) - width + 1
    factors = _gram_factors(n)
    sums = np.zeros(starts, dtype=np.uint64)
    for k in range(width):
        sums += points[k : k + starts] * factors[k]
    found = np.sort(mix(sums))  # np.unique takes several times as long
    return found[np.r_[True, found[1:] != found[:-1]]]


MOST_PARITIES = 1 << 15


def parities(grams: np.ndarray, each: int = 2, most: int = MOST_PARITIES) -> bytes:
    """Whether the set holds an odd number of members in each of 2^k hashed slots, about ``each`` for a member (Mitzenmacher et al., WWW 2014).

    Two sets' parities differ in no more slots than there are members that only one of them has, which is an exact bound on their similarity.
    """
    return np.packbits(slot_counts(grams, each, most) & 1).tobytes()


def slot_counts(grams: np.ndarray, each: int = 2, most: int = MOST_PARITIES) -> np.ndarray:
    """How many members of the set are in each of 2^k hashed slots, about ``each`` for a member."""
    slots = min(max(64, 1 << (each * len(grams) - 1).bit_length()), most) if len(grams) else 64
    return np.bincount((mix(grams) >> np.uint64(40)).astype(np.int64) % slots, minlength=slots)


def differing(a: bytes, b: bytes) -> int:
    """Slots in which the parities differ; the longer ones are folded to the length of the others."""
    n = min(len(a), len(b))
    x, y = (np.bitwise_xor.reduce(np.frombuffer(p, np.uint8).reshape(-1, n), axis=0) for p in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


class PigeonholeTokens:
    """Tokens with the guarantee that two sets of Jaccard similarity >= t have one in common.

    Such sets differ in at most k = (1-t)/(1+t) * (|A|+|B|) members.  Deal all members into more than k
    groups by hash: the differences cannot touch every group, so at least one group is equal in both sets,
    and the hash of a whole group is a token.  A group holds several members, so unrelated sets hardly ever
    agree on one, and no statistics about the corpus are needed.  (The idea is the first level of PartEnum,
    Arasu et al., VLDB 2006.)

    k depends on the sizes, so sizes are cut into classes by the factor 1/t^2; similar sets lie in the same
    or in neighbouring classes.  A set of class c emits for the scheme c, and for c+1 if it is large enough to be similar to a set of that
    class.

    Not every group is needed.  A set sorts its groups, those of most members first (a large group says more), and keeps k+1 for the k of its own
    size and the largest similar one.  That order depends on a group's content alone, so the first group that is equal in both sets stands behind k others
    at most in either.  Empty groups stand last and are kept only if too few are filled.

    The number of shared tokens says more: every kept group that isn't equal in the other set holds a difference of its own.  So similar
    sets share at least (the fewer kept groups - differences) tokens of a scheme, see :meth:`need`.  That scheme is the one of the larger set's class; a token's
    last bit tells its scheme from the neighbouring ones, so two sets of one class don't meet in the next class's scheme.
    """

    counted = False  # whether it needs the corpus's gram counts

    plausible = "TRUE"  # SQL for whether two rows ``a`` and ``b`` may be similar by the bits that their sketches keep

    def expected(self, members: int) -> int:
        """About how many tokens sets of so many members have in all."""
        return math.ceil(2 * (1 - self.t) / (1 + self.t) * 2 * members)

    def __init__(self, threshold: float):
        self.t = threshold
        self.starts = [1]

    def _class_of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(math.floor(self.starts[-1] / self.t**2 + 1e-9) + 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def _differences(self, a: int, b: int) -> int:
        return math.floor((1 - self.t) / (1 + self.t) * (a + b) + 1e-9)

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
        """The tokens, [class, the fewest that any set keeps in the scheme of the class, and in the next one], and no bits."""
        if not len(grams):
            return grams, [0, 0, 0], []
        size = len(grams)
        c = self._class_of(size)
        self._class_of(self.starts[c + 1])
        tokens, fewest = [], []
        mixed = mix(grams)
        for scheme in (c, c + 1):
            start, largest = self.starts[scheme], self.starts[scheme + 1] - 1
            if scheme > c and size / self.t + 1e-6 < start:
                fewest.append(0)
                break
            most = self._differences(largest, largest) + 1
            groups = most + most // 20
            group = grams % np.uint64(groups)
            order = np.argsort(group)
            ids, first = np.unique(group[order], return_index=True)
            # The sum of the mixed hashes stands for the group's members, whatever their order.
            sums, members = np.add.reduceat(mixed[order], first), np.diff(np.r_[first, size])
            kept = self._differences(size, min(math.floor(size / self.t + 1e-6), largest)) + 1
            fewest.append(self._differences(math.ceil(start * self.t - 1e-6), start) + 1)
            if len(ids) < kept:
                every, filled = np.zeros(groups, dtype=np.uint64), np.zeros(groups, dtype=np.int64)
                every[ids.astype(np.int64)], filled[ids.astype(np.int64)] = sums, members
                ids, sums, members = np.arange(groups, dtype=np.uint64), every, filled
            found = mix(sums ^ mix(ids + np.uint64(scheme << 32))) >> np.uint64(1) << np.uint64(1) | np.uint64(scheme & 1)
            tokens.append(found[np.lexsort((found, -members))[:kept]])
        return np.concatenate(tokens), [c, *fewest], []

    def facts(self, token: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        """Of rows at their tokens: class, tokens in its scheme and in the next one, and whether the token is of the row's own class."""
        self._class_of(int(size.max(initial=1)))
        self._class_of(self.starts[-1])
        starts = np.array(self.starts)
        c = np.searchsorted(starts, size, side="right") - 1
        largest_similar = np.floor(size / self.t + 1e-6).astype(np.int64)
        lower, upper = (np.floor((1 - self.t) / (1 + self.t) * (size + np.minimum(largest_similar, starts[c + k] - 1)) + 1e-9).astype(np.int64) + 1 for k in (1, 2))
        return {"class": c, "lower": lower, "upper": np.where(largest_similar >= starts[c + 1], upper, 0), "own": token & 1 == c & 1}

    def need(self, rows: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many tokens pairs share at least if they are similar."""
        above = rows["class"][lo] - rows["class"][hi]
        kept = np.minimum(np.where(above < 0, rows["upper"][lo], rows["lower"][lo]), np.where(above > 0, rows["upper"][hi], rows["lower"][hi]))
        differences = np.floor((1 - self.t) / (1 + self.t) * (rows["size"][lo] + rows["size"][hi]) + 1e-6).astype(np.int64)
        return np.maximum(kept - differences, 1)




class RareTokens:
    """The prefix of a set in the order of rarity in the corpus (Bayardo et al., WWW 2007; positions as in Xiao et al., WWW 2008).

    Sets of Jaccard similarity >= t share ceil(t |A|) members of A at least, so the rarest |A| - ceil(t |A|) + 1 members of each hold
    one that they share, whatever the order, as long as it is the same for all sets.  Rarity is counted in ``SLOTS`` hashed counters, a table of
    fixed size; its ties are broken by the hash.

    Places in that order bound the overlap: of two rows whose first common member stands at the places i and j (from 0), the overlap is at most
    1 + min(|A| - 1 - i, |B| - 1 - j).  Against groups of members (``PigeonholeTokens``) it takes far fewer tokens at low thresholds, but a single
    member says less than a group of several.
    """

    SLOTS = 1 << 20
    counted = indexed = True
    joined = False  # nearly all rows share one at a low threshold, or in a large corpus

    def __init__(self, threshold: float, counts: np.ndarray | None = None):
        self.t, self.counts = threshold, counts

    def shared(self, size: int, kept: int, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How many tokens a row shares with others at least if they are similar, by their sizes and numbers of tokens.

        What the row whose prefix ends first in the order has in common beyond the prefixes lies behind its own.
        """
        overlap = np.ceil(self.t / (1 + self.t) * (size + sizes) - 1e-6).astype(np.int64)
        return np.maximum(overlap - np.maximum(size - kept, sizes - counts), 1)

    plausible = "TRUE"

    def expected(self, members: int) -> int:
        return math.ceil((1 - self.t) * members)

    def tokens(self, grams: np.ndarray) -> np.ndarray:
        most = len(grams) - math.ceil(self.t * len(grams) - 1e-9) + 1 if len(grams) else 0
        rarity = self.counts[(grams % np.uint64(self.SLOTS)).astype(np.int64)]
        return grams[np.lexsort((grams, rarity))[:most]]

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
        return self.tokens(grams), [], []

    def facts(self, token: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        return {}

    def need(self, rows: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many members pairs share at least if they are similar."""
        return np.ceil(self.t / (1 + self.t) * (rows["size"][lo] + rows["size"][hi]) - 1e-6).astype(np.int64)


class MinHashTokens:
    """MinHash bands (Broder 1997): sets of Jaccard similarity s share a token with 1 - (1 - s^rows)^bands.

    For a threshold the fewest hashes are taken that find a pair at the threshold with ``RECALL``: of the widest bands first
    (up to 5 rows, which keeps unrelated sets apart), as many bands as that needs, at most ``MOST`` hashes.

    Each row also keeps one bit of each of ``BITS`` further hashes (Li and Koenig, WWW 2010).  Two rows' bits agree with a probability of
    (1 + s) / 2, so a pair with fewer equal bits than one at the threshold has but once in 1 / ``MISSED`` cases isn't similar, and its sets
    need not be fetched.
    """

    RECALL = 0.9999
    MOST = 640
    BITS = 256
    MISSED = 1e-7
    counted = False
    indexed = joined = True
    AT_ONCE = 16  # hashes of all members

    def __init__(self, threshold: float):
        self.t = threshold
        self.bands, self.rows = self.tuned(threshold)
        self.factors = odd_multipliers(self.bands * self.rows, 2)
        self.bit_factors = odd_multipliers(self.BITS, 3)

    @classmethod
    def tuned(cls, threshold: float) -> tuple[int, int]:
        """(bands, rows) for a threshold."""
        for rows in (5, 4, 3, 2, 1):
            share = threshold**rows
            bands = 1 if share >= 1 else math.ceil(math.log1p(-cls.RECALL) / math.log1p(-share))
            if bands * rows <= cls.MOST or rows == 1:
                return max(bands, 1), rows
        raise AssertionError

    def expected(self, members: int) -> int:
        return math.ceil(self.bands * members / 256)  # texts are longer as a rule

    @classmethod
    def fewest_equal(cls, threshold: float) -> int:
        """The largest number that a pair at the threshold falls short of with a probability of ``MISSED`` at most."""
        p, below = (1 + threshold) / 2, 0.0
        for k in range(cls.BITS + 1):
            below += math.comb(cls.BITS, k) * p**k * (1 - p) ** (cls.BITS - k)
            if below > cls.MISSED:
                return k
        return cls.BITS

    @property
    def plausible(self) -> str:
        unequal = " + ".join(f"bit_count(a.bits[{i}] ^ b.bits[{i}])" for i in range(self.BITS // 64))
        return f"size(a.bits) = 0 OR {unequal} <= {self.BITS - self.fewest_equal(self.t)}"

    def facts(self, token: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        return {}

    def need(self, rows: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return np.ones(len(lo), np.int64)

    def _lows(self, grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """The smallest hash of any member, for each hash."""
        out = np.empty(len(factors), np.uint64)
        for k in range(0, len(factors), self.AT_ONCE):
            np.minimum.reduce(grams * factors[k : k + self.AT_ONCE, None], axis=1, out=out[k : k + self.AT_ONCE])
        return out

    def tokens(self, grams: np.ndarray) -> np.ndarray:
        if not len(grams):
            return grams
        tokens = np.arange(self.bands, dtype=np.uint64)
        for row in self._lows(grams, self.factors).reshape(self.bands, self.rows).T:
            tokens = mix(tokens ^ row)
        return tokens

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
        if not len(grams):
            return grams, [], []
        # The smallest product's own low bit isn't even: small products of odd factors say something about the gram.
        bits = mix(self._lows(grams, self.bit_factors)) & np.uint64(1)
        return self.tokens(grams), [], np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def gram_sets(rows: DataFrame, n: int) -> DataFrame:
    """(ord, gram_text) -> (ord, grams): the hashed n-gram set of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            sets = [gram_hashes(t.as_py(), n).view(np.int64) for t in batch.column("gram_text")]
            yield pa.RecordBatch.from_arrays([batch.column("ord"), pa.array(sets, pa.list_(pa.int64()))], names=["ord", "grams"])

    return ship_package(rows).select("ord", "gram_text").mapInArrow(run, "ord bigint, grams array<bigint>")


def similarities(pairs: DataFrame, n: int, threshold: float) -> DataFrame:
    """(lo, hi, similarity) of the pairs (lo, hi, lo_text, hi_text) that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, np.ndarray] = {}

        def grams_of(text: str) -> np.ndarray:
            if text not in sets:
                if len(sets) >= TEXTS:
                    sets.clear()
                sets[text] = gram_hashes(text, n)
            return sets[text]

        for batch in batches:
            lo, hi = batch.column("lo").to_pylist(), batch.column("hi").to_pylist()
            out = []
            for a, b in zip(batch.column("lo_text"), batch.column("hi_text"), strict=True):
                x, y = grams_of(a.as_py()), grams_of(b.as_py())
                shared = len(np.intersect1d(x, y, assume_unique=True))
                every = len(x) + len(y)
                out.append(shared / (every - shared) if every else 1.0)
            found = pa.RecordBatch.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(out, pa.float64())], names=["lo", "hi", "similarity"])
            yield found.filter(pa.array([s >= threshold for s in out], pa.bool_()))

    return ship_package(pairs).select("lo", "hi", "lo_text", "hi_text").mapInArrow(run, "lo bigint, hi bigint, similarity double")


def gram_counts(rows: DataFrame, n: int, slots: int) -> np.ndarray:
    """How many rows (ord, gram_text) hold each gram, in ``slots`` hashed counters; what meets on the driver has this fixed size."""
    pieces = 64
    width = slots // pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, n_held = np.zeros(slots, np.int64), [], 0
        for batch in batches:
            for text in batch.column("gram_text"):
                held.append((gram_hashes(text.as_py(), n) % np.uint64(slots)).astype(np.int64))
                n_held += len(held[-1])
                if n_held >= 4 * slots:
                    counts += np.bincount(np.concatenate(held), minlength=slots)
                    held, n_held = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=slots)
        own_counts = pa.array([counts[i * width : (i + 1) * width].tobytes() for i in range(pieces)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), own_counts], names=["piece", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], names=["piece", "counts"])

    own = ship_package(rows).select("ord", "gram_text").mapInArrow(run, "piece int, counts binary")
    whole = own.repartition("piece").mapInArrow(add, "piece int, counts binary")
    out = np.zeros(slots, np.int64)
    for row in whole.collect():  # 64 pieces
        out[row.piece * width : (row.piece + 1) * width] = np.frombuffer(row.counts, np.int64)
    return out


def alike_enough(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (lo, hi) of rows (lo, hi, lo_size, hi_size, lo_parity, hi_parity) whose parities allow for the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("lo_size").to_numpy() + batch.column("hi_size").to_numpy()
            most = (1 - threshold) / (1 + threshold) * sizes + 1e-6
            found = zip(batch.column("lo_parity").to_pylist(), batch.column("hi_parity").to_pylist(), most, strict=True)
            yield batch.select(["lo", "hi"]).filter(pa.array([differing(a, b) <= m for a, b, m in found], pa.bool_()))

    return ship_package(pairs).select("lo", "hi", "lo_size", "hi_size", "lo_parity", "hi_parity").mapInArrow(run, "lo bigint, hi bigint")


TEXTS = 256  # whose sets a task holds at once
PACKED = 1 << 20  # tokens that a task holds before it packs them

_SKETCH = {"row": pa.int64(), "size": pa.int32(), "bits": pa.list_(pa.int64()), "parity": pa.binary()}
_PACK = {"part": pa.int32(), "rows": pa.int32(), "ords": pa.binary(), "sizes": pa.binary(), "counts": pa.binary(), "places": pa.binary(), "tokens": pa.binary()}
SKETCH_SQL = "row bigint, size int, bits array<bigint>, parity binary"


def _filled(columns: dict, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.nulls(n, t) if (v := columns.get(c)) is None else v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest one needs."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def _packed_ords(ords: np.ndarray) -> bytes:
    """Sorted ones: the first, which may be below 0, and the differences."""
    return int(ords[0]).to_bytes(8, "little", signed=True) + _narrow(np.diff(ords, prepend=ords[0]).view(np.uint64))


def _unpacked_ords(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_wide(data[8:], n)) + int.from_bytes(data[:8], "little", signed=True)


class _Packer:
    """Rows' tokens, dealt to parts by their hash; a pack is what some rows have in one part.

    Without places 32 bits of a token are kept in its part: two tokens that agree there are one, which can only make rows meet that need not.
    """

    def __init__(self, parts: int, places: bool):
        self.parts, self.places, self.held, self.n = parts, places, [], 0

    def add(self, ord_: int, size: int, tokens: np.ndarray) -> None:
        self.held.append((ord_, size, tokens))
        self.n += len(tokens)

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        held = sorted((h for h in self.held if len(h[2])), key=lambda h: h[0])
        ords, sizes, lengths = (np.array(c, np.int64) for c in zip(*((o, s, len(t)) for o, s, t in held), strict=True))
        tokens = np.concatenate([t for _, _, t in held])
        row = np.repeat(np.arange(len(held)), lengths)
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.held, self.n = [], 0
        part = ((tokens >> np.uint64(32)) % np.uint64(self.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, tokens, row, place = part[order], tokens[order], row[order], place[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        out: dict[str, list] = {c: [] for c in _PACK}
        for begin, end in zip(starts, np.r_[starts[1:], len(part)], strict=True):
            own = row[begin:end]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            here = own[first]
            out["part"].append(int(part[begin]))
            out["rows"].append(len(here))
            out["ords"].append(_packed_ords(ords[here]))
            out["sizes"].append(_narrow(sizes[here]))
            out["counts"].append(_narrow(np.diff(np.r_[first, len(own)])))
            out["places"].append(_narrow(place[begin:end]) if self.places else b"")
            out["tokens"].append((tokens[begin:end] if self.places else tokens[begin:end].astype(np.uint32)).tobytes())
        yield _filled(out, _SKETCH | _PACK)


def _unpacked(pack: dict, places: bool) -> dict[str, np.ndarray]:
    n, counts = pack["rows"], _wide(pack["counts"], pack["rows"])
    ords = _unpacked_ords(pack["ords"], n)
    if places:
        tokens = np.frombuffer(pack["tokens"], np.int64)
        place = _wide(pack["places"], len(tokens))
    else:
        tokens = np.frombuffer(pack["tokens"], np.uint32).astype(np.int64) + (pack["part"] << 32)
        place = np.zeros(len(tokens), np.int64)
    return {"token": tokens, "ord": np.repeat(ords, counts), "size": np.repeat(_wide(pack["sizes"], n), counts), "place": place}


def sketches(rows: DataFrame, n: int, tokens_of, parts: int) -> DataFrame:
    """(ord, gram_text) -> sketches (row, size, bits, parity), and packs of tokens, which have the other columns filled; all have a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(parts, tokens_of.counted)
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            out: dict[str, list] = {c: [] for c in [*_SKETCH, "part"]}
            for ord_, text in zip(batch.column("ord").to_pylist(), batch.column("gram_text").to_pylist(), strict=True):
                grams = gram_hashes(text, n)
                tokens, _, bits = tokens_of(grams)
                if ord_ is not None:
                    packer.add(ord_, len(grams), tokens)
                for c, value in zip(out, (ord_, len(grams), bits, parities(grams), hash(ord_) % parts), strict=True):
                    out[c].append(value)
            yield _filled(out, _SKETCH | _PACK)
            if packer.n >= PACKED:
                yield from packer.packed()
        yield from packer.packed()

    schema = f"{SKETCH_SQL}, part int, rows int, ords binary, sizes binary, counts binary, places binary, tokens binary"
    return ship_package(rows).select("ord", "gram_text").mapInArrow(run, schema)


FLUSH = 1 << 20  # pairs that a task holds before it counts equal ones and passes them on
_SMALL = 32  # buckets of up to so many rows are paired all at once


def _cells(ords: np.ndarray, cells: int) -> np.ndarray:
    """The cell of a row; a pair has that of its earlier row."""
    return (mix(ords.view(np.uint64)) % np.uint64(cells)).astype(np.int64)


def _summed(pairs: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Each pair once, sorted: tokens seen, the fewest needed, and the fewest members left behind a place."""
    every = {c: np.concatenate([p[c] for p in pairs]) for c in pairs[0]}
    order = np.lexsort((every["hi"], every["lo"]))
    every = {c: v[order] for c, v in every.items()}
    first = np.flatnonzero(np.r_[True, (np.diff(every["lo"]) != 0) | (np.diff(every["hi"]) != 0)])
    merged = {"seen": np.add, "need": np.minimum, "left": np.minimum}
    return {c: merged[c].reduceat(v, first) if c in merged else v[first] for c, v in every.items()}


_PAIRS = {"pairs": pa.int32(), "rows": pa.int32(), "los": pa.binary(), "counts": pa.binary(), "his": pa.binary(), "seen": pa.binary(), "need": pa.binary(), "left": pa.binary()}


PAIR_COLUMNS = list(_PAIRS)


class _Pairs:
    """Pairs that have met, counted before they leave the task in packs; a pack is what has one cell."""

    def __init__(self, tokens_of, cells: int):
        self.tokens_of, self.cells, self.held, self.n = tokens_of, cells, [], 0

    def add(self, rows: dict[str, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> None:
        """Pairs of row numbers; those whose sizes, places, or tokens' classes rule similarity out are left out."""
        t, small, large = self.tokens_of.t, rows["size"][lo], rows["size"][hi]
        fits = np.minimum(small, large) >= t * np.maximum(small, large) - 1e-6
        left = None
        if self.tokens_of.counted:
            left = np.minimum(small - 1 - rows["place"][lo], large - 1 - rows["place"][hi])
            fits &= 1 + left >= np.ceil(t / (1 + t) * (small + large) - 1e-6)
        if "own" in rows:
            fits &= rows["own"][lo] | rows["own"][hi]
        fits &= ~rows["gone"][lo] & (rows["ord"][lo] < rows["ord"][hi])
        lo, hi = lo[fits], hi[fits]
        if len(lo):
            found = {"lo": rows["ord"][lo], "hi": rows["ord"][hi], "seen": np.ones(len(lo), np.int64), "need": self.tokens_of.need(rows, lo, hi)}
            self.held.append(found if left is None else found | {"left": left[fits]})
            self.n += len(lo)

    def packed(self) -> pa.RecordBatch:
        pairs = _summed(self.held)
        self.held, self.n = [], 0
        cell = _cells(pairs["lo"], self.cells)
        order = np.argsort(cell, kind="stable")
        cell, pairs = cell[order], _part(pairs, order)
        starts = np.flatnonzero(np.r_[True, np.diff(cell) != 0])
        out: dict[str, list] = {c: [] for c in ["cell", *_PAIRS]}
        for begin, end in zip(starts, np.r_[starts[1:], len(cell)], strict=True):
            own = _part(pairs, slice(begin, end))
            first = np.flatnonzero(np.r_[True, np.diff(own["lo"]) != 0])
            out["cell"].append(int(cell[begin]))
            out["pairs"].append(int(end - begin))
            out["rows"].append(len(first))
            out["los"].append(_packed_ords(own["lo"][first]))
            out["counts"].append(_narrow(np.diff(np.r_[first, end - begin])))
            out["his"].append(_narrow((own["hi"] - own["lo"]).view(np.uint64)))
            for c in ("seen", "need", "left"):
                out[c].append(_narrow(own[c]) if c in own else b"")
        return _met(out)


def _unpacked_pairs(pack: dict) -> dict[str, np.ndarray]:
    n = pack["pairs"]
    lo = np.repeat(_unpacked_ords(pack["los"], pack["rows"]), _wide(pack["counts"], pack["rows"]))
    return {"lo": lo, "hi": lo + _wide(pack["his"], n)} | {c: _wide(pack[c], n) for c in ("seen", "need", "left") if pack[c]}


_MET = {"cell": pa.int32(), **_PAIRS, "token": pa.int64(), "ord": pa.int64(), "facts": pa.int64(), "behind": pa.bool_()}


def _met(columns: dict) -> pa.RecordBatch:
    return _filled({c: pa.array(v) if isinstance(v, np.ndarray) else v for c, v in columns.items()}, _MET)


def _part(rows: dict[str, np.ndarray], chosen) -> dict[str, np.ndarray]:
    return {c: v[chosen] for c, v in rows.items()}


def _joined(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([a[c], b[c]]) for c in a}


class _Buckets:
    """Pairs the rows of each token as they come, sorted by (token, gone, ord).

    The token that may go on in the next batch is *open*: its rows that aren't gone are held while they are at most ``bucket`` (FILLING); once gone rows
    follow they have been paired with each other (PAIRED); if there are more, only the heads are held (CROWDED).
    """

    FILLING, PAIRED, CROWDED = range(3)

    def __init__(self, tokens_of, bucket: int, heads: int, cells: int):
        self.pairs, self.bucket, self.heads = _Pairs(tokens_of, cells), bucket, heads
        self.open: dict[str, np.ndarray] | None = None
        self.state = self.FILLING

    def flushed(self, least: int = FLUSH) -> Iterator[pa.RecordBatch]:
        if self.pairs.n >= least:
            yield self.pairs.packed()

    def read(self, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = rows | self.pairs.tokens_of.facts(rows["token"], rows["size"])
        if self.open is not None:
            same = int(np.searchsorted(rows["token"] != self.open["token"][0], True))
            if same:
                yield from self._goes_on(_part(rows, slice(0, same)))
                rows = _part(rows, slice(same, None))
            if not len(rows["ord"]):
                return
            yield from self.close()
        starts = np.flatnonzero(np.r_[True, rows["token"][1:] != rows["token"][:-1]])
        yield from self._whole(_part(rows, slice(0, starts[-1])), starts)
        self.open, self.state = _part(rows, slice(0, 0)), self.FILLING
        yield from self._goes_on(_part(rows, slice(starts[-1], None)))

    def close(self) -> Iterator[pa.RecordBatch]:
        """The open token is complete."""
        if self.open is not None and self.state == self.FILLING:
            yield from self._among(self.open)
        self.open = None

    def _goes_on(self, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if self.state == self.FILLING:
            rows = _joined(self.open, rows)
            here = int((~rows["gone"]).sum())
            self.open = _part(rows, slice(0, here))
            if here > self.bucket:
                self.state, self.open = self.CROWDED, _part(rows, slice(0, self.heads))
            elif here < len(rows["ord"]):
                yield from self._among(self.open)
                self.state, rows = self.PAIRED, _part(rows, slice(here, None))
        if self.state == self.CROWDED:
            yield from self._crowded(rows, self.open)
        elif self.state == self.PAIRED:
            yield from self._against(self.open, rows)

    def _against(self, first: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        both, n = _joined(first, rows), len(first["ord"])
        for i in range(n):
            self.pairs.add(both, np.full(len(both["ord"]) - n, i), np.arange(n, len(both["ord"])))
            yield from self.flushed()

    def _crowded(self, rows: dict[str, np.ndarray], first: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield from self._against(first, rows)
        behind = ~rows["gone"] & (rows["ord"] > first["ord"][-1])
        yield _met({"cell": _cells(rows["ord"], self.pairs.cells), "token": rows["token"], "ord": rows["ord"], "facts": rows["facts"], "behind": behind})

    def _among(self, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        n = len(rows["ord"])
        for i in range(n - 1):
            self.pairs.add(rows, np.full(n - 1 - i, i), np.arange(i + 1, n))
            yield from self.flushed()

    def _whole(self, rows: dict[str, np.ndarray], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Tokens whose rows are all here, between the bounds."""
        if len(bounds) < 2:
            return
        starts, lengths = bounds[:-1], np.diff(bounds)
        here = np.add.reduceat((~rows["gone"]).astype(np.int64), starts)
        small = (lengths > 1) & (lengths <= _SMALL) & (here <= self.bucket)
        behind = np.repeat(np.where(small, lengths, 0), lengths) - (np.arange(len(rows["ord"])) - np.repeat(starts, lengths))
        for apart in range(1, int(lengths[small].max(initial=1))):
            lo = np.flatnonzero(behind > apart)
            self.pairs.add(rows, lo, lo + apart)
            yield from self.flushed()
        for token in np.flatnonzero((lengths > 1) & ~small):
            own = _part(rows, slice(bounds[token], bounds[token + 1]))
            if here[token] > self.bucket:
                yield from self._crowded(own, _part(own, slice(0, self.heads)))
            else:
                yield from self._among(own)


_PAIRS_SQL = "cell int, pairs int, rows int, los binary, counts binary, his binary, seen binary, need binary, left binary"
_MET_SQL = f"{_PAIRS_SQL}, token bigint, ord bigint, facts bigint, behind boolean"


def first_meetings(sketched: DataFrame, tokens_of, bucket: int, heads: int, cells: int) -> DataFrame:
    """As :func:`meetings`, from the packs of :func:`sketches`, which have to be sorted by part in partitions by part; sketches pass through.

    A task holds one part at a time.
    """

    def met(packs: list[dict]) -> Iterator[pa.RecordBatch]:
        buckets, found = _Buckets(tokens_of, bucket, heads, cells), [_unpacked(p, tokens_of.counted) for p in packs]
        rows = {c: np.concatenate([r[c] for r in found]) for c in found[0]}
        # A token that only one row has pairs nothing.
        order = np.lexsort((rows["ord"], rows["token"]))
        token = rows["token"][order]
        again = np.r_[False, token[1:] == token[:-1]]
        rows = _part(rows, order[again | np.r_[again[1:], False]])
        if len(rows["ord"]):
            facts = (rows["size"] << 32) + rows["place"]
            yield from buckets.read(rows | {"facts": facts, "gone": np.zeros(len(facts), bool)})
            yield from buckets.close()
            yield from buckets.flushed(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: list[dict] = []
        types = _MET | _SKETCH

        def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _filled({c: batch.column(c) for c in _MET}, types)

        for batch in batches:
            sketch = batch.filter(batch.column("rows").is_null())
            if sketch.num_rows:
                yield _filled({c: sketch.column(c) for c in _SKETCH}, types)
            for pack in batch.filter(batch.column("rows").is_valid()).select(list(_PACK)).to_pylist():
                if packs and packs[0]["part"] != pack["part"]:
                    yield from map(whole, met(packs))
                    packs = []
                packs.append(pack)
        if packs:
            yield from map(whole, met(packs))

    return ship_package(sketched).select(*_SKETCH, *_PACK).mapInArrow(run, f"{_MET_SQL}, {SKETCH_SQL}")


def meetings(entries: DataFrame, tokens_of, bucket: int, heads: int, cells: int) -> DataFrame:
    """What happens at each token of the entries (token, ord, facts, gone), which have to be sorted by (token, gone, ord) in partitions by token.

    ``facts`` is size * 2^32 + place.  A token's rows that aren't gone are paired with each other and, as the earlier one, with those that are.  If they
    are more than ``bucket``, only the first ``heads`` of them are paired with all others, and all entries of the token are passed on.
    Result rows are packs of pairs, each with the number of tokens seen in this task's share, and passed-on entries (cell, token, ord, facts, behind), where
    ``behind`` marks rows that aren't gone and stand behind the heads.  A pair goes to the cell of its earlier row.  A task holds one bucket at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets(tokens_of, bucket, heads, cells)
        for batch in batches:
            if batch.num_rows:
                rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "ord", "facts", "gone")}
                yield from buckets.read(rows | {"size": rows["facts"] >> 32, "place": rows["facts"] & 0xFFFFFFFF})
        yield from buckets.close()
        yield from buckets.flushed(1)

    return ship_package(entries).select("token", "ord", "facts", "gone").mapInArrow(run, _MET_SQL)


def counted_pairs(packs: DataFrame) -> DataFrame:
    """(lo, hi, short): the pairs of packs (cell, ...) that may be similar by the tokens that they share, from all tasks.

    ``short`` is how many more tokens they have to share, which may only be such as the earlier row still has in crowded buckets: the frame also holds rows
    (cell, ord, hidden) with their number.  It has to be sorted by cell, whole cells in a partition; a task holds one cell.
    """

    def counted(pairs: list[dict[str, np.ndarray]], hidden: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        if not pairs:
            return
        every = _summed(pairs)
        short = every["need"] - every["seen"] - every.get("left", 0)
        ords, numbers = np.array(sorted(hidden), np.int64).reshape(-1, 2).T
        ords, numbers = np.r_[ords, np.iinfo(np.int64).max], np.r_[numbers, 0]
        at = np.searchsorted(ords, every["lo"])
        fits = short <= np.where(ords[at] == every["lo"], numbers[at], 0)
        yield pa.RecordBatch.from_arrays([pa.array(v[fits], pa.int64()) for v in (every["lo"], every["hi"], short)], names=["lo", "hi", "short"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, pairs, hidden, n = None, [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    yield from counted(pairs, hidden)
                    cell, pairs, hidden, n = row["cell"], [], [], 0
                if row["ord"] is not None:
                    hidden.append((row["ord"], row["hidden"]))
                    continue
                pairs.append(_unpacked_pairs(row))
                n += row["pairs"]
                if n >= 4 * FLUSH:
                    pairs, n = [_summed(pairs)], 0
        yield from counted(pairs, hidden)

    return ship_package(packs).mapInArrow(run, "lo bigint, hi bigint, short bigint")


class _Marks:
    """A set of integers, a bit each in pieces of 65,536."""

    def __init__(self):
        self.pieces: dict[int, bytearray] = {}

    def add(self, x: int) -> None:
        piece = self.pieces.setdefault(x >> 16, bytearray(8192))
        piece[(x & 0xFFFF) >> 3] |= 1 << (x & 7)

    def __contains__(self, x: int) -> bool:
        piece = self.pieces.get(x >> 16)
        return piece is not None and bool(piece[(x & 0xFFFF) >> 3] >> (x & 7) & 1)


def greedy_walk(pairs: DataFrame) -> DataFrame:
    """(ord, leader_ord, similarity) of the rows of similar pairs (root, lo, hi, similarity, lo_open, hi_open) that go.

    The pairs have to be sorted by (root, hi, lo), whole components in a partition.  Rows are visited in order: one goes if an earlier similar row is kept, and the first such is its
    leader; it waits if it is open, or if an earlier similar row waits and none is kept (its leader is null); else it is kept.
    A component is a stream: what is remembered of it are a bit for each row that went and each that waits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, gone, waiting = None, _Marks(), _Marks()
        hi, leader, similarity, waits = None, None, None, False
        out: list[tuple] = []

        def close() -> None:
            if hi is not None and leader is not None:
                gone.add(hi)
                out.append((hi, leader, similarity))
            elif hi is not None and waits:
                waiting.add(hi)
                out.append((hi, None, None))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["ord", "leader_ord", "similarity"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("root", "lo", "hi", "similarity", "lo_open", "hi_open"))
            for its_root, lo, its_hi, its_similarity, lo_open, hi_open in zip(*columns, strict=True):
                if its_root != root or its_hi != hi:
                    close()
                    if its_root != root:
                        root, gone, waiting = its_root, _Marks(), _Marks()
                    hi, leader, similarity, waits = its_hi, None, None, hi_open
                if leader is not None or lo in gone:
                    continue
                if lo_open or lo in waiting:
                    waits = True
                else:
                    leader, similarity = lo, its_similarity
            if out:
                yield batch_of(out)
                out = []
        close()
        if out:
            yield batch_of(out)

    return ship_package(pairs).select("root", "lo", "hi", "similarity", "lo_open", "hi_open").mapInArrow(run, "ord bigint, leader_ord bigint, similarity double")
