import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tidemark.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows, entries=256, rounds=4, parts=4):
    """Every distance in Python's whole numbers."""
    kept = []
    for i, v, label, _ in rows:
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v], label))
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    width = size // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == e]
                    if own:
                        books[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], digest) for (i, _, label), f, err in zip(kept, found, errors, strict=True)), key=str
    )


def answer(spark, rows, **options):
    found = codes.compress(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()), key=str)


def cloud(seed, n, dim=8, step=None):
    rng = np.random.default_rng(seed)
    found = []
    for i in range(n):
        v = rng.normal(size=dim) * 0.2
        if step:
            v = np.round(v / step) * step
        found.append((i * 2, [float(np.float32(x)) for x in v], int(rng.integers(3)) if i % 7 else None, "clash"))
    return found


@pytest.mark.parametrize(("entries", "first_share", "step"), [(16, 8, None), (16, 1, 0.25), (24, 24, 0.125), (2, 8, None), (1, 8, None)])
def test_equal_to_all_distances(spark, entries, first_share, step):
    rows = cloud(entries, 300, step=step)
    rows += [(10_000, None, 1, ""), (10_001, [], 1, ""), (10_002, [1.0, None] * 4, 1, ""), (10_003, [float("nan")] * 8, 1, ""),
             (10_004, [float("-inf")] * 8, 1, ""), (10_005, [1.0] * 7, 1, ""), (10_006, [1.0] * 12, 1, ""), (None, rows[0][1], 2, ""),
             (4, rows[1][1], 2, ""), (4, rows[2][1], 2, ""), (10_007, rows[0][1], None, ""), (10_008, [0.0] * 8, 0, "")]
    assert answer(spark, rows, entries=entries, first_share=first_share) == brute(rows, entries)


def test_fewer_vectors_than_entries(spark):
    rows = cloud(3, 5) + cloud(3, 5)
    assert answer(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x)) for x in v], 0, "") for i, v in enumerate(np.random.default_rng(4).normal(size=(60, 8)) * 50_000)]
    assert answer(spark, rows, entries=8) == brute(rows, 8)
    with pytest.raises(PySparkException, match="beyond"):
        answer(spark, [*rows, (99, [1e9] * 8, 0, "")], entries=8)


def test_empty(spark):
    assert answer(spark, []) == answer(spark, [(1, None, 1, "")]) == []


def test_bounds_leave_little_to_compute(spark, monkeypatch):
    """The second pass over vectors near their entries compares few of them with all entries."""
    rng = np.random.default_rng(9)
    books = rng.normal(size=(64, 4)) * 1000
    x = np.round(books[rng.integers(64, size=2000)] + rng.normal(size=(2000, 4)) * 20).astype(np.int64)
    books = np.round(books).astype(np.int64)
    bounds = codes.Bounds(len(x), 8)
    bounds._all(np.arange(len(x)), x, books)
    moved = books + rng.integers(-10, 10, size=books.shape)
    bounds.moved(np.sqrt(((moved - books) ** 2).sum(axis=1)))
    full = []
    monkeypatch.setattr(codes.Bounds, "_all", lambda self, rows, *_: full.append(len(rows)))
    bounds.assign(x, moved)
    assert sum(full) == 0 and (bounds.needed > 0).mean() < 0.05
    assert (bounds.code == codes.squared(x, moved).argmin(axis=1)).all()
