import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import resampling

SCHEMA = "doc_id long, text string, rank string, n int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target, percent=5, least=20):
    """Every feature of every text counted by itself."""
    source, wanted = Counter(), Counter()
    for _, t in rows:
        source.update(map(bucket, runs(t)[1]))
    for t in target:
        wanted.update(map(bucket, runs(t)[1]))
    s_all, t_all = sum(source.values()) + 10_000, sum(wanted.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all)))
    out, able = [], []
    for k, (d, t) in enumerate(rows):
        w, features = runs(t)
        weight = sum(gain(bucket(f)) for f in features)
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(features), weight, score, None])
        if d is not None and len(w) >= least:
            able.append((-score, d, k))
    for rank, (_, _, k) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def answer(spark, rows, target, **options):
    docs = spark.createDataFrame([(d, t, "clash", 0) for d, t in rows], SCHEMA)
    found = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in found.collect()), key=str)


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcXYZ01é漢") for _ in range(rng.choice([1, 2, 5, 9, 70]))) for _ in range(80)]
    lines = [rng.choice([" ", ", ", "-"]).join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    rows = [(i * 3, rng.choice(["\n", "\n\n", "\r\n"]).join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(150)]
    rows += [(9_000, None), (9_001, ""), (9_002, "\n\n"), (9_003, "one"), (9_004, "one\ntwo"), (9_005, "one\n\ntwo\nthree four"), (None, rows[0][1])]
    rows += [(9_010 + i, lines[3] + "\n" + lines[5]) for i in range(20)]
    return rows, [rng.choice(lines) + " " + rng.choice(words) + "\n" + rng.choice(words) for _ in range(30)]


@pytest.mark.parametrize("percent", [5, 50])
def test_equal_to_brute_force(spark, monkeypatch, percent):
    monkeypatch.setattr(resampling, "BATCH_BYTES", 3000)
    rows, target = corpus()
    assert answer(spark, rows, target, percent=percent) == brute(rows, target, percent)


def test_repeated_rows_and_ids(spark):
    rows, target = corpus()
    rows = rows[:40] + rows[:10] + [(rows[0][0], rows[1][1])]
    got, want = answer(spark, rows, target, percent=30), brute(rows, target, 30)
    # Of rows that tie in all but their text, either may come first.
    assert sorted(r[:4] for r in got if r[0] is not None) == sorted(r[:4] for r in want if r[0] is not None)
    assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])


def test_very_long_text(spark):
    rng = random.Random(1)
    long = "\n".join(" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(1, 2000))) for _ in range(100))
    rows = [(1, long), (2, "x" * 100_000 + " " + "y" * 50_000 + "\n" + "z" * 90_000)]
    assert answer(spark, rows, ["alpha beta"]) == brute(rows, ["alpha beta"])


def test_empty_tables(spark):
    assert answer(spark, [], ["a b"]) == []
    rows = [(1, "a b c"), (2, None)]
    assert answer(spark, rows, []) == brute(rows, [])
    assert answer(spark, rows, [None, ""]) == brute(rows, [])
