import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import decontaminate as dc

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("items", T.StringType()),
])


def plain_distance(item, text):
    """Least edit distance of the item to any part of the text, cell by cell."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        following = [0]
        for i, x in enumerate(item, 1):
            following.append(min(column[i] + 1, following[-1] + 1, column[i - 1] + (x != c)))
        column = following
        best = min(best, column[-1])
    return best


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = int(rng.integers(len(out)))
        kind = rng.integers(3)
        if kind == 0:
            out[at] = "#"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "é")
    return "".join(out)


def corpus(seed=2):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "tion", "heren", "ndou", "anst", "erin", "blesh"]
    items = [(i, " ".join(rng.choice(words, 12 + i))) for i in range(12)]
    docs = []
    for i in range(80):
        text = " ".join(rng.choice(words, 40))
        if i % 2:
            item = items[i % 12][1]
            text = text[:50] + " " + edited(rng, item, int(rng.integers(0, len(item) // 7))) + text[50:]
        docs.append(text)
    return items, docs + ["", "The  " + items[0][1].upper().replace(" ", "\n")]


def test_myers_equals_the_table():
    rng = np.random.default_rng(0)
    for _ in range(60):
        item = "".join(rng.choice(list("abc"), int(rng.integers(1, 90))))
        text = "".join(rng.choice(list("abc"), int(rng.integers(0, 120))))
        assert dc.Pattern(item).distance(text) == plain_distance(item, text)


def test_matcher_finds_what_the_table_finds():
    items, docs = corpus()
    normal_items = [(i, dc.normal(t)) for i, t in items]
    matcher = dc.Matcher(normal_items)
    near = 0
    for text in map(dc.normal, docs):
        want = {i: d for i, t in normal_items if (d := plain_distance(t, text)) <= dc.budget(len(t))}
        assert dict(matcher.find(text)) == want
        near += any(want.values())
    assert near > 5


def test_find_items_in_blocks(spark, monkeypatch):
    items, docs = corpus(4)
    bench = spark.createDataFrame([*items, (items[0][0], items[0][1]), (50, None), (51, ""), (None, "x y z")], "item_id long, text string")
    rows = [(i, t, "clash") for i, t in enumerate(docs)] + [(None, None, None), (3, docs[3], "again")]
    frame = spark.createDataFrame(rows, DOCS)
    first = {(r.doc_id, r.n_items): [tuple(i) for i in r["items"]] for r in dc.find_items(frame, bench).collect()}
    matcher = dc.Matcher([(i, dc.normal(t)) for i, t in items])
    assert {i: v for (i, _), v in first.items()} == {i: matcher.find(dc.normal(t)) for i, t, _ in rows}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    again = {(r.doc_id, r.n_items): sorted(tuple(i) for i in r["items"]) for r in dc.find_items(frame, bench).collect()}
    assert again == first
    clean = dc.keep_clean(frame, bench)
    assert clean.columns == frame.columns
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {i for (i, n) in first if n == 0}


@pytest.mark.parametrize("rows", [[], [(1, "a text", None)]])
def test_empty_tables(spark, rows):
    frame = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    got = dc.find_items(frame, bench).collect()
    assert [(r.doc_id, r.contaminated) for r in got] == [(1, False)] * len(rows)


def test_a_task_holds_one_block_of_items(spark, monkeypatch):
    items, docs = corpus(6)
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], DOCS)
    whole = dc.find_items(frame, bench).collect(), dc.keep_clean(frame, bench).collect()
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    found, clean = dc.find_items(frame, bench), dc.keep_clean(frame, bench)
    for result in (found, clean):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1
    assert sorted((r.doc_id, sorted(map(tuple, r["items"]))) for r in found.collect()) == sorted((r.doc_id, sorted(map(tuple, r["items"]))) for r in whole[0])
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in whole[1])
