import itertools

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import simhash
from tidemark.llm.common import Scratch, components

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("code", T.StringType()),
])


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints, bits=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= bits:
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: root(i) for i in ids}


def test_fingerprint_equals_the_definition():
    texts = ["", None, " \t\n", "One", "one two", "A b  C", "Ärger ÄRGER x\x0by\x1fz q", "a b c a b c a b c", "w " * 3000]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(words, rng.integers(40, 300))) for _ in range(60)]
    for text in texts[:30]:
        parts = text.split()
        for _ in range(3):
            changed = list(parts)
            changed[int(rng.integers(len(changed)))] = "other"
            texts.append(" ".join(changed))
    texts += [texts[0]] * 5 + [None, "", "  ", "ONE two", "one TWO"]
    rows = [(i * 7, t, "clash") for i, t in enumerate(texts)]
    rows += [(None, texts[1], "clash"), (7, texts[1], "clash")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t, _ in rows if i is not None}
    want = reachable(prints)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.fingerprint == f"{plain_fingerprint(texts[1]):016x}"
        else:
            assert row.fingerprint == f"{prints[row.doc_id]:016x}"
            assert row.component_id == want[row.doc_id]


def test_dense_codes_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 40, dtype=np.int64)
    codes = [int(c) ^ (1 << int(b)) ^ (1 << int(d)) for c in centres for b, d in rng.integers(0, 62, (12, 2))]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "doc_id long, code long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: frame)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert got == reachable(dict(enumerate(codes)))


def test_close_codes_and_forest():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 50, dtype=np.uint64)
    codes = np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(6 << 20)])
    ranks = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(s)
    codes = codes[np.argsort(ranks)]
    found = {(int(a), int(b)) for x, y in simhash.close_codes(codes, codes, 2) for a, b in zip(x, y, strict=True)}
    assert found == {(i, j) for i in range(150) for j in range(150) if bin(int(codes[i]) ^ int(codes[j])).count("1") <= 2}
    links = simhash.forest([(np.array([1, 2, 1, 3]), np.array([2, 3, 3, 3]))])
    assert len(links) == 2


def test_gray_rank_orders_like_the_sequence(spark):
    codes = [(i, (i ^ (i >> 1))) for i in range(64)]
    frame = spark.createDataFrame(codes, "place long, code long").withColumn("rank", simhash.gray_rank(F.col("code")))
    assert [r.place for r in frame.orderBy("rank").collect()] == list(range(64))


def test_keep_one_and_empty(spark):
    docs = spark.createDataFrame([(3, "a b c d", "x"), (1, "A b c d", "y"), (None, "a b c d", "z"), (9, "q", "x")], SCHEMA)
    assert sorted((r.doc_id or 0) for r in simhash.keep_one(docs).collect()) == [0, 1, 9]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(10, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 10 for i in range(10, 61)} | {1000 + i: 1000 for i in range(200)}
