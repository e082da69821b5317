"""Vector codes against exhaustive comparison."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwright.llm import codes


def test_slices_find_the_nearest():
    rnd = np.random.default_rng(3)
    for size, count, spread in [(16, 256, 100), (3, 256, 4), (1, 200, 3), (5, 1, 50), (2, 65, 10**6), (8, 64, 0)]:
        book = rnd.integers(-spread, spread + 1, (count, size))
        rows = np.concatenate([rnd.integers(-3 * spread - 5, 3 * spread + 6, (700, size)), book, book + 1])
        distance = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
        index, error = codes.Slices(book).nearest(rows)
        assert (index == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()


def test_slices_leave_most_entries_out():
    rnd = np.random.default_rng(4)
    book = rnd.integers(-10_000, 10_000, (256, 8))
    rows = book[rnd.integers(0, 256, 500)] + rnd.integers(-50, 50, (500, 8))
    row, _ = codes.Slices(book).candidates(rows, np.full(500, 200))
    assert 500 <= len(row) < 2 * 500


def expected(rows):
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    x = np.floor(np.array([r[1] for r in kept], np.float64) * 1024).astype(np.int64)
    found, books = [], []
    for part in np.split(x, 4, axis=1):
        book = part[:256].copy()
        nearest = lambda: ((part[:, None, :] - book[None]) ** 2).sum(axis=2)  # noqa: E731, B023
        for _ in range(4):
            index = nearest().argmin(axis=1)
            for e in set(index.tolist()):
                book[e] = part[index == e].sum(axis=0) // (index == e).sum()
        distance = nearest()
        found.append((distance.argmin(axis=1), distance.min(axis=1)))
        books.append(book)
    digest = hashlib.sha256(",".join(str(v) for book in books for v in book.ravel()).encode()).hexdigest()
    error = sum(e for _, e in found)
    by_label = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        by_label[label] = by_label.get(label, 0) + e
    code = ["".join(f"{int(i[k]):02x}" for i, _ in found) for k in range(len(kept))]
    return sorted(((str(r[0]), c, e, by_label[r[2]], digest) for r, c, e in zip(kept, code, error.tolist())))


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, `group` int, error string")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_compress(spark, kind):
    rnd = np.random.default_rng(7)
    x = rnd.standard_normal((900, 8)).astype(np.float32 if kind == "float" else np.float64)
    x[300:340] = x[5]
    rows = [(i * 3 % 911, v.tolist(), [None, 1, 2][i % 3]) for i, v in enumerate(x)]
    odd = [(1, None, 1), (2, [1.0] * 7 + [None], 1), (3, [float("nan")] * 8, 2), (4, [float("-inf")] * 8, 2), (900_000, [1.0] * 4, 1), (900_001, [], 1)]
    rows += odd + [(None, [0.5] * 8, None), (None, [-0.5] * 8, 1), rows[7], rows[7]]
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.compress(table(spark, rows, kind).repartition(5)).collect())
    assert got == expected(rows)


def test_few_and_none(spark):
    rows = [(5, [1.0, 2.0, -3.0, 0.1], 1), (9, [1.0, 2.0, -3.0, 0.2], None)]
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.compress(table(spark, rows)).collect())
    assert got == expected(rows) and [g[2] for g in got] == [0, 0]
    assert codes.compress(table(spark, rows).where(F.col("vec_id") < 0)).collect() == []
    with pytest.raises(ValueError):
        codes.compress(table(spark, [(1, [1.0] * 3, 1)]))


def test_large_components(spark):
    rows = [(i, [(-1.0) ** i * 60_000.0 + i, 0.0, 1.0, float(i)], i % 2) for i in range(40)]
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.compress(table(spark, rows, "double")).collect())
    assert got == expected(rows)
    assert (codes.whole_numbers(np.array([[1e5, -1e5]])) == [[102_400_000, -102_400_000]]).all()
    for large in (1e7, 1e300):
        with pytest.raises(ValueError):
            codes.whole_numbers(np.array([[large, 0.0]]))
