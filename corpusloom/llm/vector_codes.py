"""Product quantisation of integer vectors; the codebooks come from ball k-means.

Vectors are cut into equal parts and each part position has a codebook.  A round assigns every part to the nearest entry and then moves
each entry to the mean of its parts.  Assigning follows balls (Xia et al., "A fast adaptive k-means with no bounds"): the parts that
an entry holds are a ball around it, whose radius is the distance of the farthest one.  Another entry can take a part over only if half of the
way to it is within the radius, which makes it a *neighbour*; a part nearer to its entry than half of the way to the nearest neighbour is in
the ball's *stable core* and stays; any other lies in a *ring* between two of those half ways and is compared with the neighbours up to
its ring alone.  A ball whose entry and neighbours haven't moved is skipped.  All of it is done on squared integers, so it is exact.

Spark reads the vectors once per round: a task assigns its rows batch by batch (a batch's parts of one entry are a ball), and adds up their
parts by entry, so what meets on the driver is one row per entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import in_arrow, materialize
from corpusloom.llm.vectors import LONG_MAX, clamped, integer_vectors, largest, matrix

PARTS, ENTRIES, ROUNDS = 16, 64, 2

Codebooks = list[list[list[int]]]  # components by part, entry and position


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def assign(points: np.ndarray, own: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point (of equally near ones the first) and its squared distance.

    ``own`` are the points' entries so far; ``moved`` tells which entries have changed since those were the nearest.
    """
    own = own.copy()
    away = _squared(points, entries[own])
    order = np.argsort(own, kind="stable")
    starts = np.searchsorted(own[order], np.arange(len(entries) + 1))
    for i in range(len(entries)):
        ball = order[starts[i] : starts[i + 1]]
        if not len(ball):
            continue
        apart = _squared(entries, entries[i])
        radius = away[ball].max()
        near = np.array([j for j in np.argsort(apart, kind="stable") if j != i and apart[j] <= 4 * radius], np.int64)
        if not len(near) or not (moved[i] or moved[near].any()):
            continue
        ring = np.searchsorted(apart[near], 4 * away[ball], side="right")  # neighbours that come into question
        outside = ball[ring > 0]
        if not len(outside):
            continue
        rings = ring[ring > 0]
        near = near[: rings.max()]
        distances = _squared(points[outside][:, None, :], entries[near][None, :, :])
        # The smallest (distance, entry) as one number.
        keys = distances * len(entries) + near
        keys[np.arange(len(near)) >= rings[:, None]] = (away[outside].max() + 1) * len(entries)
        least = np.minimum(keys.min(axis=1), away[outside] * len(entries) + i)
        own[outside] = (least % len(entries)).astype(np.int64)
        away[outside] = least // len(entries)
    return own, away


def _assigned(rows: DataFrame, books: Codebooks, before: Codebooks | None) -> DataFrame:
    """The rows with ``codes`` for the codebooks and the ``error``; then each task's sums by part and entry (part isn't null).

    A sum is kept in two halves of 32 bits, so that none overflows.  ``before`` are the codebooks of the rows' codes; None: no codes yet.
    """
    parts, width = len(books), len(books[0][0])
    most = max((abs(x) for book in [*books, *(before or [])] for entry in book for x in entry), default=0)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = None
        counts = np.zeros((parts, len(books[0])), np.int64)
        sums = np.zeros((2, parts, len(books[0]), width), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.schema.field("label").type
            whole = matrix(batch.column("vector"), parts * width)
            bound = (2 * max(most, largest(whole))) ** 2 * max(width, 1) * 4 * len(books[0])
            kind = np.int64 if bound < 1 << 62 else object
            errors = np.zeros(batch.num_rows, kind)
            if before is None:
                codes = np.zeros((batch.num_rows, parts), np.uint8)
            else:
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, parts).copy()
            for p in range(parts):
                points = whole[:, p * width : (p + 1) * width].astype(kind)
                entries = np.array(books[p], kind).reshape(-1, width)
                moved = np.array([before is None or now != then for now, then in zip(books[p], before[p] if before else books[p], strict=True)])
                own, away = assign(points, codes[:, p].astype(np.int64), entries, moved)
                codes[:, p] = own
                errors = errors + away
                counts[p] += np.bincount(own, minlength=len(entries))
                for c in range(width):
                    value = whole[:, p * width + c]
                    for half, own_half in enumerate((value >> 32, value & 0xFFFFFFFF)):
                        # Sums of 32 bits over one batch are exact in a double.
                        added = np.bincount(own, weights=own_half.astype(np.float64), minlength=len(entries))
                        sums[half, p, :, c] += added.astype(np.int64)
            none = batch.num_rows
            columns = [batch.column("vec_id"), batch.column("label"), batch.column("vector"), pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(clamped(errors), pa.int64())]
            columns += [pa.nulls(none, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=_schema(label))
        used = [(p, e) for p, e in zip(*np.nonzero(counts), strict=True)]
        if used:
            none = len(used)
            columns = [pa.nulls(none, t) for t in (pa.int64(), label, pa.list_(pa.int64()), pa.binary(), pa.int64())]
            columns += [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([counts[u] for u in used], pa.int64())]
            columns += [pa.array([[int(x) for x in sums[half][u]] for u in used], pa.list_(pa.int64())) for half in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=_schema(label))

    label = rows.schema["label"].dataType.simpleString()
    wanted = rows.select("vec_id", "label", "vector", *([] if before is None else ["codes"]))
    return in_arrow(wanted, step, f"vec_id long, label {label}, vector array<bigint>, codes binary, error long, part int, entry int, count long, high array<bigint>, low array<bigint>")


def _schema(label: pa.DataType) -> pa.Schema:
    longs = pa.list_(pa.int64())
    fields = [("vec_id", pa.int64()), ("label", label), ("vector", longs), ("codes", pa.binary()), ("error", pa.int64())]
    return pa.schema(fields + [("part", pa.int32()), ("entry", pa.int32()), ("count", pa.int64()), ("high", longs), ("low", longs)])


def _means(assigned: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the floors of the means of what they hold; unused entries stay."""
    sums = assigned.filter("part IS NOT NULL")
    width = len(books[0][0])
    halves = [F.sum(F.col(h)[c]).alias(f"{h}_{c}") for h in ("high", "low") for c in range(width)]
    new = [list(book) for book in books]
    for row in sums.groupBy("part", "entry").agg(F.sum("count").alias("n"), *halves).collect():  # a row per entry
        new[row.part][row.entry] = [((row[f"high_{c}"] << 32) + row[f"low_{c}"]) // row.n for c in range(width)]
    return new


def encode(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Rows (vec_id, label, codes, error) and the codebooks they refer to.

    ``embeddings`` has vec_id, embedding and label (any of them may be null, other columns are ignored).  Rows whose vector is null or holds
    nulls or values that aren't finite are left out; a component x becomes floor(256 * x).  Vectors are filled up with zeros to the longest length, rounded
    up to a multiple of ``parts``.  The codebooks start as the parts of the vectors with the smallest vec_ids (null first, ties by vector), ``entries`` (at most
    256) of them or as many as there are, and are moved ``rounds`` times.  codes holds one byte per part; error is the sum of the squared distances, at most the
    largest long.  Equal vectors get equal codes, so repeated rows and ties need no order.  An empty table gives no rows and no codebooks.
    """
    rows = materialize(integer_vectors(embeddings.withColumn("vec_id", F.col("vec_id").cast("long")), "vec_id", "label"), "vectors")
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    first = [list(r.vector) for r in rows.orderBy("vec_id", "vector").limit(entries).collect()]  # at most 256 vectors
    if not first:
        return rows.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), []
    padded = [v + [0] * (parts * width - len(v)) for v in first]
    books: Codebooks = [[v[p * width : (p + 1) * width] for v in padded] for p in range(parts)]
    before, assigned = None, rows
    for _ in range(rounds):
        assigned = materialize(_assigned(assigned.filter("vector IS NOT NULL"), books, before), "assigned")
        before, books = books, _means(assigned, books)
    assigned = materialize(_assigned(assigned.filter("vector IS NOT NULL"), books, before), "codes")
    return assigned.filter("vector IS NOT NULL").select("vec_id", "label", "codes", "error"), books


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 over the decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """(its_label, label_error): one row per label, null among them."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    return coded.groupBy(F.col("label").alias("its_label")).agg(total.alias("label_error"))
