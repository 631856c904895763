import hashlib
import random

import pytest

from tidemark.llm import suffixes

LENGTH = 50
SCHEMA = "doc_id long, text string, kept string, part int"


def brute(rows):
    """Every string of every text in one dictionary."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, data in texts:
        for i in range(len(data) - LENGTH + 1) if d is not None else ():
            least[data[i : i + LENGTH]] = min(d, least.get(data[i : i + LENGTH], d))
    out = []
    for d, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1) if d is not None else ():
            if least[data[i : i + LENGTH]] < d:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    some = lambda low, high: " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))
    phrases = [some(3, 30) for _ in range(30)]
    rows = [
        (i * 7 % 151, " ".join(rng.choice(phrases) if rng.random() < 0.3 else some(1, 20) for _ in range(rng.randint(0, 12))))
        for i in range(150)
    ]
    # Copies, runs of one byte, no text, ids that repeat with the same and with other texts.
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    rows += [(2000, "a" * 3000), (2001, "b" + "a" * 2000 + "c"), (2002, None), (2003, ""), (None, rows[3][1]), (3, rows[5][1]), (3, rows[3][1])]
    rows += [(-5, rows[8][1]), (3000, "\0" * 200 + "x"), (3001, "\0" * 120), (3002, "x" * 49), (3003, "x" * 49), (3004, "y" * 50), (3005, "y" * 50)]
    # One passage that very many documents hold between texts of their own.
    return rows + [(4000 + i, f"{rng.random()} the common line of all documents {rng.random()}") for i in range(200)]


def answer(found):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found.collect()), key=str)


@pytest.mark.parametrize(("run_bytes", "range_items"), [(4 << 20, 400_000), (3000, 200), (1000, 20)])
def test_equal_to_brute_force(spark, run_bytes, range_items):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "clash", 0) for d, t in rows], SCHEMA)
    assert answer(suffixes.cut_repeats(docs, run_bytes=run_bytes, range_items=range_items)) == brute(rows)


def test_very_long_text_in_parts(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    rows = [(1, long[10_000:11_000]), (2, long), (3, long[:5_000] + "!" + long[20_000:])]
    assert answer(suffixes.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), run_bytes=4096)) == brute(rows)


def test_empty(spark):
    assert suffixes.cut_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    assert answer(suffixes.cut_repeats(spark.createDataFrame([(1, None, None, None)], SCHEMA))) == brute([(1, None)])


def test_too_short_strings_are_refused(spark):
    with pytest.raises(ValueError, match="more than 12"):
        suffixes.cut_repeats(spark.createDataFrame([], SCHEMA), length=12)


def test_merge_equals_a_sort():
    rng = random.Random(1)
    runs = []
    for _ in range(13):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(10)) for _ in range(rng.randint(0, 40)))
        shared = [0] + [next((i for i in range(10) if a[i] != b[i]), 10) for a, b in zip(strings, strings[1:], strict=False)]
        runs.append((strings, shared[: len(strings)]))
    order, shared = suffixes.merged(runs, 10)
    every = [s for strings, _ in runs for s in strings]
    merged = [every[i] for i in order]
    assert merged == sorted(every)
    assert shared[1:] == [next((i for i in range(10) if a[i] != b[i]), 10) for a, b in zip(merged, merged[1:], strict=False)]


def test_groups_survive_equal_hashes(monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffixes, "_mixed", lambda x: x * np.uint64(0))
    left = np.array([[1, 2], [1, 2], [1, 3], [1, 2]], np.uint8)
    sizes = np.array([2, 2, 2, 1])
    got = suffixes._groups(np.array([0, 0, 0, 0]), np.zeros(4, np.uint64), left, sizes, None)
    assert got[0] == got[1] and len(set(got.tolist())) == 3
