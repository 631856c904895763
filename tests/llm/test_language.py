import collections
import math
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import attention, language

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("chunk", T.StringType()),
])


def rest(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 5


def plain(rows):
    """Counts and base scores by the definition."""
    def words(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in lowered.translate({i: " " for i in range(9, 14)}).split(" ") if w] + [None]

    counts = collections.Counter(w for i, t, _ in rows if i is not None and rest(i) != 1 for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t, _ in rows:
        ws = words(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((str(i), rest(i) == 1, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out)


def corpus(n=150, seed=0):
    """Two word stocks; a text keeps to one, which only context can tell."""
    rng = np.random.default_rng(seed)
    stocks = [[f"{a}{b}" for a in x for b in x] for x in (["the", "an", "or", "ish"], ["le", "eau", "que", "oi"])]
    rows = []
    for i in range(n):
        stock = stocks[int(rng.integers(2))]
        rows.append((i, " ".join(rng.choice(stock, int(rng.integers(20, 80)))).capitalize(), "clash"))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus() + [(900, None, ""), (901, "", ""), (902, " \t\n", ""), (903, "Ünseen wörds\x1f here", ""), (None, "The an", ""), (3, "again", ""), (3, "again", "")]
    rows.append((904, "thean " * 5000, ""))
    return rows, language.score_texts(spark.createDataFrame(rows, SCHEMA), PATH).collect()


def test_counts_and_base(scored):
    rows, got = scored
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain(rows)


def test_held_out_texts_score_better_than_the_base(scored):
    _, got = scored
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_chunks_and_windows_do_not_change_the_counts(spark, monkeypatch, scored):
    monkeypatch.setattr(language, "CHUNK_WORDS", 700)
    monkeypatch.setattr(language, "BLOCK_WORDS", 150)
    rows, _ = scored
    got = language.score_texts(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain(rows)


def test_empty(spark):
    assert language.score_texts(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    held = next(i for i in range(50) if rest(i) == 1)
    row = language.score_texts(spark.createDataFrame([(held, "a b", "")], SCHEMA), PATH).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.base_score == pytest.approx(0.0)


def test_every_target_is_scored_once_with_context():
    starts = np.cumsum([0, 0, 1, 16, 17, 28, 29, 200])
    place, fresh = attention.windows(starts)
    assert sorted(place[fresh].tolist()) == list(range(starts[-1]))
    for row, new in zip(place, fresh, strict=True):
        first = row[0]
        opening = first in starts
        assert all(opening or k >= attention.WINDOW - attention.FRESH for k in np.nonzero(new)[0])


def test_attention_is_causal_and_slopes_are_right():
    p = {k: v.astype(np.float64) for k, v in attention.start(12, 5).items()}
    rng = np.random.default_rng(0)
    x = rng.integers(0, 12, (3, attention.WINDOW))
    y = rng.integers(0, 5, x.shape)
    weight = (rng.random(x.shape) < 0.7).astype(float)
    before, _ = attention.forward(p, x)
    changed = x.copy()
    changed[:, 9:] = 0
    after, _ = attention.forward(p, changed)
    assert np.allclose(before[:, :9], after[:, :9]) and not np.allclose(before[:, 9:], after[:, 9:])
    _, g = attention.gradients(p, x, y, weight)
    for name in p:
        at = tuple(int(rng.integers(s)) for s in p[name].shape)
        step = 1e-5
        p[name][at] += step
        up, _ = attention.gradients(p, x, y, weight)
        p[name][at] -= 2 * step
        down, _ = attention.gradients(p, x, y, weight)
        p[name][at] += step
        assert g[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-4), name


def test_every_training_word_reaches_a_window(spark):
    rows = corpus(40) + [(904, "thean " * 5000, ""), (905, "", ""), (906, None, ""), (None, "not learned", "")]
    frame = spark.createDataFrame([(i, t, rest(i)) for i, t, _ in rows], "doc_id long, text string, rest int")
    subwords = language.Subwords(PATH)
    chunks = frame.mapInArrow(language._chunks(PATH), language._CHUNK_SCHEMA).where("part = 'stream'").collect()
    learned = collections.Counter()
    for r in chunks:
        stream = language._unpack(r.stream)
        _, place, fresh = language.training_windows(stream, subwords.size)
        assert sorted(place[fresh].tolist()) == list(range(len(stream)))
        learned.update(stream.tolist())
    want = collections.Counter()
    for i, t, _ in rows:
        if i is not None and rest(i) != 1:
            want.update(np.frombuffer(b"".join(subwords.ids(language.tokens(t))), "<u4").tolist() + [subwords.size])
    assert learned == want


def test_words_after_a_long_opening_are_learned(spark):
    """A net that has seen only the same twelve words of every text scores the rest far below the base."""
    opening = "the an or ish le eau que oi the an or ish "
    rows = [(i, opening + t, "") for i, t, _ in corpus(150, 3)]
    got = language.score_texts(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)


@pytest.fixture(scope="module")
def documents(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    return spark.read.parquet(path)


def test_documents_score_better_than_the_base_however_they_are_partitioned(documents):
    found = []
    for parts in (1, 5):
        rows = language.score_texts(documents.repartition(parts), PATH).select("doc_id", "held_out", "base_score", "score").collect()
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
        found.append({r.doc_id: r.score for r in rows})
    assert found[0].keys() == found[1].keys()
    assert max(abs(found[0][i] - found[1][i]) / max(1.0, abs(found[0][i])) for i in found[0]) < 1e-6


def test_repeated_texts_train_by_their_number(spark, documents):
    """Copies meet in one shard as one text with a weight, so they never fill a task."""
    some = documents.limit(30)
    copies = some.where("doc_id % 5 = 2").select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("k"), "doc_id", "text")
    rows = some.select("doc_id", "text").unionByName(copies.select((F.col("doc_id") * 1000 + F.col("k")).alias("doc_id"), "text"))
    assert language.score_texts(rows, PATH).count() == rows.count()


def test_streams_go_once_they_are_learned_from(spark, monkeypatch):
    """What only training reads is off the disk before texts are scored."""
    made = []

    class Noted(language.Scratch):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self.path)

    monkeypatch.setattr(language, "Scratch", Noted)
    rows = [(i, f"some words of text {i}") for i in range(20)]
    scored = language.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    left = {name for path in made for name in os.listdir(path) if not name.endswith("-totals")}
    assert left == {"1-chunks"} and "part=stream" not in os.listdir(f"{made[0]}/1-chunks")
    assert scored.count() == 20


def test_company_counts_equal_all_pairs_in_windows():
    """Counted by the pairs that windows hold, across batches of them, without a row of all frequent subwords for each id."""
    rng = np.random.default_rng(3)
    size, windows = 300, 3 * language.BATCH_WINDOWS
    stream = rng.integers(0, size, windows * attention.FRESH)
    stream[rng.integers(0, len(stream), 90)] = size
    stream[-1] = size
    frequent = rng.permutation(size)[: language.COMPANY]
    number = np.full(size, -1)
    number[frequent] = np.arange(len(frequent))
    got = np.zeros((size, language.COMPANY))
    for part in (stream, stream[:0], np.array([size])):
        language.count_company(part, number, got)
    want = np.zeros_like(got)
    for spots in language.training_windows(stream, size)[1]:
        held = {int(i) for i in stream[spots[spots >= 0]] if i < size}
        for i in held:
            for j in held:
                want[i, number[j]] += number[j] >= 0
    assert want.sum() > 0 and (got == want).all()


def test_gradients_add_up_equal_input_rows():
    """Rows that come many times in a batch, next to some that never come."""
    rng = np.random.default_rng(4)
    p = attention.start(9, 5)
    x, y = rng.integers(0, 4, (30, attention.WINDOW)), rng.integers(0, 5, (30, attention.WINDOW))
    weight = (rng.random(x.shape) < 0.7).astype(np.float32)
    _, whole = attention.gradients(p, x, y, weight)
    parts = [attention.gradients(p, x[k : k + 1], y[k : k + 1], weight[k : k + 1])[1] for k in range(30)]
    sizes = np.maximum(weight.sum(axis=1), 1)
    for name in p:
        added = sum(g[name] * n for g, n in zip(parts, sizes, strict=True)) / weight.sum()
        assert np.allclose(whole[name], added, atol=1e-5) and whole[name].dtype == p[name].dtype
    assert not whole["embed"][4:].any()
