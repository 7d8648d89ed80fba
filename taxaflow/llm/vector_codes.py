"""Vector codes: vectors cut into parts, every part replaced by the index of its codebook's nearest entry.

Nearest entries are found by slicing and intersecting.  For each dimension the codebook's coordinates are sorted,
and before each of them stands a bit mask of all entries sorted earlier.  A radius around a point is a range of
each dimension; the masks at the range's ends differ by exactly the entries inside, and the AND over all
dimensions leaves the entries in the box around the point.  The initial radius is the distance to a neighbour in
the dimension of widest spread, so the box holds every entry that is as near or nearer.

Defined results: rows without vector, with a missing or non-finite component, or of another width than the row of
smallest vec_id take no part; so do all rows if that width can't be cut into equal parts.  Rows without vec_id come
last in order.  Repeated rows are rows of their own.  Integer components are clipped at 2^62, errors at 2^63 - 1.
An empty table gives an empty result.  Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import share, shared_value, stored, with_group_value

MOST = 2**63 - 1
CLIP = 2**62


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as whole numbers: 64 bits where squared distances fit, else Python's."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() * scale < 2**26:
        return np.floor(values * scale).astype(np.int64)
    whole = [max(-CLIP, min(CLIP, math.floor(x * scale) if abs(x) < 2**52 else int(x) * scale)) for x in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _whole(rows: list[list[int]]) -> np.ndarray:
    """Entries in 64 bits if they are small, else as Python's whole numbers."""
    large = any(abs(x) >= 2**26 for row in rows for x in row)
    return np.array(rows, dtype=object if large else np.int64)


def _radius(squares: np.ndarray) -> np.ndarray:
    """A whole number not below the root."""
    if squares.dtype == object:
        return np.array([math.isqrt(s) + 1 for s in squares.tolist()], dtype=object)
    return np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64) + 1


class Codebook:
    """Entries of one part position, with sorted coordinates and prefix masks for the search."""

    def __init__(self, entries: list[list[int]]):
        self.entries = _whole(entries)
        count, width = self.entries.shape
        self.words = -(-count // 64)
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, self.order, axis=0)
        self.prefix = np.zeros((width, count + 1, self.words), np.uint64)
        for d in range(width):
            for k, e in enumerate(self.order[:, d].tolist()):
                self.prefix[d, k + 1] = self.prefix[d, k]
                self.prefix[d, k + 1, e // 64] |= np.uint64(1 << (e % 64))
        spread = [self.sorted[-1, d] - self.sorted[0, d] for d in range(width)]
        self.widest = spread.index(max(spread))

    def _squares(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        difference = points - entries
        return (difference * difference).sum(axis=1)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries whose coordinates all lie within the radius, 64 entries a word."""
        mask = np.full((len(points), self.words), ~np.uint64(0))
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, "right")
            mask &= self.prefix[d, high] ^ self.prefix[d, low]
        return mask

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry (the lower one of equals) and the squared distance."""
        if points.dtype != self.entries.dtype:
            points = points.astype(object)
        best = np.zeros(len(points), np.int64)
        if not len(points):
            return best, best
        d, last = self.widest, len(self.entries) - 1
        place = np.searchsorted(self.sorted[:, d], points[:, d])
        sides = [self.order[np.clip(place - step, 0, last), d] for step in (0, 1)]
        initial = np.minimum(*(self._squares(points, self.entries[s]) for s in sides))
        mask = self.candidates(points, _radius(initial))
        error = initial + 1
        for e in range(len(self.entries)):
            rows = np.flatnonzero(mask[:, e // 64] & np.uint64(1 << (e % 64)))
            found = self._squares(points[rows], self.entries[e])
            nearer = found < error[rows]
            best[rows[nearer]], error[rows[nearer]] = e, found[nearer]
        return best, error


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), scale)


def usable(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """``vec_id, label, embedding`` of the rows with a whole vector, of one width if it is given."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & finite)
    return kept.where(F.size("embedding") == width) if width else kept


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int) -> list[list[list[int]]]:
    """Codebooks made of the ``entries`` rows of smallest vec_id; none if there is no vector that can be cut."""
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding"), F.asc_nulls_last("label")]
    first = usable(vectors).orderBy(*order).first()
    width = len(first["embedding"]) if first else 0
    if not width or width % parts:
        return []
    rows = usable(vectors, width).orderBy(*order).limit(entries).collect()
    whole = scaled(np.array([r["embedding"] for r in rows], np.float64), scale).tolist()
    step = width // parts
    return [[row[p * step:(p + 1) * step] for row in whole] for p in range(parts)]


def assigned_sums(vectors: DataFrame, books: list[list[list[int]]], scale: int) -> DataFrame:
    """``part, entry, n, s0, s1 ...``: how many parts each entry got and their sums; a task sends one row per entry at most."""
    parts, step = len(books), len(books[0][0])
    sent = share(vectors.sparkSession, [Codebook(b) for b in books])
    sums = [f"s{i}" for i in range(step)]
    exact = pa.decimal128(38, 0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = shared_value(sent)
        counts: dict[tuple[int, int], int] = {}
        totals: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            whole = _matrix(batch.column(0), parts * step, scale)
            for p, book in enumerate(codebooks):
                points = whole[:, p * step:(p + 1) * step]
                chosen, _ = book.nearest(points)
                for e in np.unique(chosen).tolist():
                    mine = points[chosen == e]
                    counts[p, e] = counts.get((p, e), 0) + len(mine)
                    totals[p, e] = [a + int(b) for a, b in zip(totals.get((p, e), [0] * step), mine.sum(axis=0).tolist())]
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64()),
             *(pa.array([totals[k][i] for k in keys], exact) for i in range(step))], ["part", "entry", "n", *sums],
        )

    schema = "part int, entry int, n bigint, " + ", ".join(f"{s} decimal(38,0)" for s in sums)
    partial = vectors.select("embedding").mapInArrow(assign, schema)
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])


def fit_codebooks(vectors: DataFrame, *, parts: int, entries: int, rounds: int, scale: int) -> list[list[list[int]]]:
    """Codebooks after ``rounds`` of assigning all rows and moving every used entry to the floored mean of its parts.

    A round reads the vectors once and collects ``parts * entries`` rows.
    """
    books = first_codebooks(vectors, parts, entries, scale)
    if not books:
        return []
    step = len(books[0][0])
    kept = usable(vectors, step * parts)
    for _ in range(rounds):
        for row in assigned_sums(kept, books, scale).collect():
            books[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(step)]
    return books


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[list[list[int]]], scale: int) -> DataFrame:
    """``vec_id, label, code, error`` of every usable row; a code has two hex digits for each part."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    if not books:
        return vectors.sparkSession.createDataFrame([], schema)
    parts, step = len(books), len(books[0][0])
    sent = share(vectors.sparkSession, [Codebook(b) for b in books])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = shared_value(sent)
        for batch in batches:
            whole = _matrix(batch.column(2), parts * step, scale)
            chosen, errors = zip(*(book.nearest(whole[:, p * step:(p + 1) * step]) for p, book in enumerate(codebooks)))
            codes = ["".join(f"{e:02x}" for e in row) for row in np.stack(chosen, axis=1).tolist()]
            total = [min(MOST, sum(row)) for row in zip(*(e.tolist() for e in errors))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(total, pa.int64())], ["vec_id", "label", "code", "error"]
            )

    return usable(vectors, parts * step).select("vec_id", "label", "embedding").mapInArrow(code, schema)


def vector_codes(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; the distances of equal labels add up to label_error."""
    if not 1 <= entries <= 256:
        raise ValueError("A code has two hex digits a part: entries must be 1 to 256")
    books = fit_codebooks(vectors, parts=parts, entries=entries, rounds=rounds, scale=scale)
    coded = stored(encode(vectors, books, scale), "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.least(exact, F.lit(MOST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    joined = with_group_value(coded, totals, "label", "label_error")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
