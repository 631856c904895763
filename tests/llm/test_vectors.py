import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import vectors

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("size", T.StringType()),
])


def brute(rows, limit=0.98):
    good = []
    for i, v, label, _ in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append((i, np.array(v, np.float32).astype(float) if ok else None, label))
    links, parent = [0] * len(rows), {i: i for i, _, _ in good if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(good)):
        for y in range(x):
            (i, a, p), (j, b, q) = good[x], good[y]
            if a is None or b is None or p != q or len(a) != len(b):
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= limit:
                links[x] += 1
                links[y] += 1
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    out = []
    for (i, _, _), n in zip(good, links, strict=True):
        component = None if i is None else root(i)
        out.append((i, n, component, None if i is None else i == component))
    return sorted(out, key=str)


def cloud(seed, n=400, dim=16, centres=25):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    rows = []
    for i in range(n):
        v = middle[rng.integers(centres)] + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.3])
        rows.append((i * 3, [float(np.float32(x)) for x in v], int(rng.integers(3)), "clash"))
    return rows


@pytest.mark.parametrize("block", [8, 1024])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = cloud(block)
    rows += [(10_000 + k, rows[0][1], rows[0][2], "copy") for k in range(7)]
    rows += [(20_000, rows[1][1], None, ""), (20_001, None, 1, ""), (20_002, [], 1, ""), (20_003, [0.0] * 16, 1, ""),
             (20_004, [1.0, None] + [0.0] * 14, 1, ""), (20_005, [float("nan")] + [1.0] * 15, 1, ""), (20_006, [float("inf")] * 16, 1, ""),
             (20_007, [1.0, 1.0], 1, ""), (20_008, [2.0, 2.0], 1, ""), (None, rows[0][1], rows[0][2], ""),
             (20_009, [-0.0] + [1.0] * 15, 1, ""), (20_010, [0.0] + [1.0] * 15, 1, ""), (3, rows[1][1], rows[1][2], "again")]
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == brute(rows)


def test_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, None, None, None)], SCHEMA)
    assert [tuple(r) for r in vectors.near_duplicates(one).collect()] == [(1, 0, 1, True)]


def test_linked_decides_close_calls_on_the_vectors():
    a = np.array([[1.0, 0.0]])
    b = np.array([[0.98, np.sqrt(1 - 0.98**2)], [0.97, 1.0], [1e200, 1e190]])
    cosine = (a @ b[0]) / (np.linalg.norm(a) * np.linalg.norm(b[0]))
    assert vectors.linked(a, b, 0.98)[0].tolist() == [bool(cosine[0] >= 0.98), False, True]
