"""Vector compression by product codebooks, assigned by slicing and intersecting bitmasks.

Vectors become integers and are cut into equal consecutive parts; every part position has
a codebook of up to 256 entries, which some rounds of averaging move among the parts.

The nearest entry is found by slices. Along each coordinate the entries are sorted, and
prefix masks tell, as 64-bit words with a bit an entry, which entries are among the first
k. A radius selects a range of every coordinate; the difference of two prefix masks is the
slice of entries inside, and the intersection of all slices holds every entry within the
radius. The first radius is the usual gap between entries. A row whose best candidate is
farther than its radius, or that has none, looks again: with that distance as the radius,
which is then enough, or with twice the radius. So the entry found is exactly the nearest.

A round sends one row per part and entry from each task (counts and sums), whatever the
number of vectors; the driver holds the codebooks alone.

Defined results: rows whose vector is missing, or has missing or non-finite components, are
left out; so are vectors that are not as long as that of the smallest id. Repeated rows
count as often as they occur. Rows of equal id start codebooks in the order of their
vectors; a missing id comes after all others. A table without vectors has no codes.
Squared distances must fit 64 bits (components up to a hundred thousand for some hundred
of them); larger ones raise an error, as do vectors that cannot be cut into equal parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import add_columns

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_ROWS = 512
MASK_WORDS = ENTRIES // 64
LARGEST_DISTANCE = float(1 << 62)


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of rows of finite doubles; scaling by a power of two is exact."""
    scaled = np.floor(SCALE * vectors.astype(np.float64))
    # Two components are at most twice the largest apart.
    if scaled.size and 2 * np.abs(scaled).max() >= (LARGEST_DISTANCE / scaled.shape[1]) ** 0.5:
        raise ValueError("squared distances of such large components do not fit 64 bits")
    return scaled.astype(np.int64)


class Slices:
    """A codebook ready for searches: per coordinate its sorted values and their prefix masks."""

    def __init__(self, codebook: np.ndarray):
        self.entries = codebook
        self.columns = np.ascontiguousarray(codebook.T)
        n = len(codebook)
        own = np.zeros((n, MASK_WORDS), np.uint64)
        own[np.arange(n), np.arange(n) // 64] = np.left_shift(np.uint64(1), (np.arange(n) % 64).astype(np.uint64))
        self.everything = np.bitwise_or.reduce(own, axis=0)
        self.sorted, self.prefix = [], []
        for values in self.columns:
            order = np.argsort(values, kind="stable")
            self.sorted.append(values[order])
            masks = np.zeros((n + 1, MASK_WORDS), np.uint64)
            masks[1:] = np.bitwise_or.accumulate(own[order], axis=0)
            self.prefix.append(masks)
        self.first_radius = self._usual_gap()

    def _usual_gap(self) -> int:
        """Median distance between entries that are neighbours along the first coordinate."""
        if len(self.entries) < 2 or not len(self.columns):
            return 1
        near = self.entries[np.argsort(self.columns[0], kind="stable")]
        gaps = np.sqrt(((near[1:] - near[:-1]).astype(np.float64) ** 2).sum(axis=1))
        return max(1, int(np.median(gaps) / 2))

    def candidates(self, rows: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, entry)`` of all entries whose every coordinate is within the row's radius."""
        masks = np.repeat(self.everything[None, :], len(rows), axis=0)
        for d, values in enumerate(self.sorted):
            low = np.searchsorted(values, rows[:, d] - radius, "left")
            high = np.searchsorted(values, rows[:, d] + radius, "right")
            masks &= self.prefix[d][high] ^ self.prefix[d][low]
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        return np.nonzero(bits)

    def distances(self, rows: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
        total = np.zeros(len(row), np.int64)
        for d, values in enumerate(self.columns):
            gap = rows[row, d] - values[entry]
            total += gap * gap
        return total

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every row, ties to the lower one, and its squared distance."""
        index = np.zeros(len(rows), np.int64)
        error = np.zeros(len(rows), np.int64)
        for start in range(0, len(rows), BLOCK_ROWS):
            block = slice(start, start + BLOCK_ROWS)
            self._nearest(rows[block], index[block], error[block])
        return index, error

    def _nearest(self, rows: np.ndarray, index: np.ndarray, error: np.ndarray) -> None:
        left = np.arange(len(rows))
        radius = np.full(len(rows), self.first_radius, np.int64)
        enough = np.zeros(len(rows), bool)
        while len(left):
            row, entry = self.candidates(rows[left], radius[left])
            distance = self.distances(rows[left], row, entry)
            # Candidates come by row, then entry: the first of the smallest is the one wanted.
            begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
            met = left[row[begins]]
            smallest = np.minimum.reduceat(distance, begins) if len(row) else distance
            at_best = np.flatnonzero(distance == np.repeat(smallest, np.diff(np.r_[begins, len(row)])))
            first = at_best[np.flatnonzero(np.r_[True, row[at_best][1:] != row[at_best][:-1]])] if len(row) else at_best
            index[met], error[met] = entry[first], smallest
            sure = enough[met] | (smallest <= radius[met] * radius[met])
            radius[left] *= 2
            radius[met] = np.ceil(np.sqrt(smallest.astype(np.float64))).astype(np.int64) + 1
            enough[met] = True
            left = np.setdiff1d(left, met[sure], assume_unique=True)


@dataclass(frozen=True)
class Codebooks:
    """``entries``: part, entry, position within the part."""

    entries: np.ndarray

    def text(self) -> str:
        return ",".join(map(str, self.entries.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and finite in every component."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where(F.col(vector).isNotNull() & F.forall(vector, number))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _parts(matrix: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(matrix, parts, axis=1)]


def train(vectors: DataFrame, id_column: str, vector: str, parts: int = PARTS, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of :func:`usable` vectors, None if there are none.

    Entries start as the parts of the vectors of smallest ids. In each round every part
    goes to its nearest entry and every entry to the floored mean of its parts; an entry
    without parts stays.
    """
    seeds = vectors.select(id_column, vector).orderBy(F.asc_nulls_last(id_column), vector).limit(ENTRIES).collect()
    if not seeds:
        return None
    width = len(seeds[0][1])
    if not width or width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    first = whole_numbers(np.array([s[1] for s in seeds if len(s[1]) == width], np.float64))
    entries = np.stack(np.split(first, parts, axis=1))
    fitting = vectors.where(F.size(vector) == width).select(vector)
    for _ in range(rounds):
        entries = _moved(fitting, entries)
    return Codebooks(entries)


def _moved(vectors: DataFrame, entries: np.ndarray) -> np.ndarray:
    parts, count, size = entries.shape

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Slices(book) for book in entries]
        n, sums = np.zeros((parts, count), np.int64), np.zeros((parts, count, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, rows in enumerate(_parts(_matrix(batch.column(0)), parts)):
                index, _ = books[p].nearest(rows)
                n[p] += np.bincount(index, minlength=count)
                np.add.at(sums[p], index, rows)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(n[p, e]), "sums": pa.array(list(sums[p, e]), pa.list_(pa.int64()))}
        )

    partial = vectors.mapInArrow(gather, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)])
    moved = entries.copy()
    for part, entry, n, *sums in total.collect():  # a row an entry at most
        moved[part, entry] = [s // n for s in sums]
    return moved


def encode(vectors: DataFrame, vector: str, codebooks: Codebooks) -> DataFrame:
    """The columns of ``vectors`` without the vector, with ``code`` (two hex digits a part) and ``error``."""
    entries = codebooks.entries
    parts, _, size = entries.shape
    others = [f for f in vectors.schema if f.name != vector]
    kept = vectors.where(F.size(vector) == parts * size).select(vector, *[F.col(f"`{f.name}`") for f in others])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "code string", "error long"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Slices(book) for book in entries]
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [book.nearest(rows) for book, rows in zip(books, _parts(_matrix(batch.column(0)), parts))]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            code = pa.array([row.tobytes().hex() for row in codes], pa.string())
            error = pa.array(sum(distance for _, distance in found))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], code, error], names=[*batch.schema.names[1:], "code", "error"])

    return kept.mapInArrow(assign, schema)


def compress(vectors: DataFrame) -> DataFrame:
    """Codes of the table's vectors with their errors, the errors of their labels and a digest of the codebooks.

    ``vectors``: ``vec_id long, embedding array<float or double>, label``.
    """
    rows = usable(vectors.select("vec_id", "embedding", "label"), "embedding")
    codebooks = train(rows, "vec_id", "embedding")
    none = "code string, error long"
    if codebooks is None:
        coded = rows.select("vec_id", "label", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in none.split(", ")])
    else:
        coded = materialize(encode(rows, "embedding", codebooks))
    # In a struct, missing labels are equal to one another.
    labelled = coded.withColumn("group", F.struct("label"))
    sums = materialize(labelled.groupBy("group").agg(F.sum("error").alias("label_error")))
    return add_columns(labelled, sums, "group", "vec_id").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks.sha256() if codebooks else None).cast("string").alias("codebooks_sha256")
    )
