import zlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import toxicity as tx

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("toxic", T.StringType()),
])
NEUTRAL = "the of and heren tion anst blesh ouerin nd stea".split()


def corpus(n=600, seed=0):
    """Toxic texts insult; they name one group more often than clean ones do, which must not count against it."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        parts = list(rng.choice(NEUTRAL, 30))
        if rng.random() < (0.7 if toxic else 0.1):
            parts.insert(5, "women")
        if toxic:
            parts[9] = rng.choice(["worthless", "idiots", "scumbag"])
        rows.append((i, " ".join(parts).capitalize() + ".", toxic))
    return rows


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], DOCS)
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")


def test_held_out_accuracy_and_fold(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in tx.score(docs, tx.train(docs, labels)).collect()}
    assert all(got[i].held_out == is_held_out(i) for i, _, _ in rows)
    held = [(got[i].predicted, x) for i, _, x in rows if is_held_out(i)]
    assert sum(p == x for p, x in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_swapping_the_group_changes_scores_less_than_without_the_penalty(spark, monkeypatch):
    docs, labels = frames(spark, corpus(seed=1))
    pairs = [("The women of heren and tion.", "The men of heren and tion."), ("Women.", "Men.")]

    def worst(model):
        logit = lambda p: np.log(p / (1 - p))
        return max(abs(logit(a) - logit(b)) for a, b in zip(*map(model.scores, zip(*pairs, strict=True)), strict=True))

    monkeypatch.setattr(tx, "COUNTERFACTUAL", 0.0)
    free = tx.train(docs, labels)
    monkeypatch.undo()
    fair = tx.train(docs, labels)
    assert worst(fair) < 0.3 * worst(free)
    assert fair.scores(["The women of heren and tion."])[0] < 0.5


def test_only_text_and_training_labels_count(spark):
    rows = corpus(seed=2)
    docs, labels = frames(spark, rows)
    model = tx.train(docs, labels)
    other = labels.withColumn("toxic", F.when(F.col("doc_id").isin([i for i, _, _ in rows if is_held_out(i)]), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.train(docs, other) == model


def test_nulls_repeats_long_and_empty(spark):
    rows = corpus(200) + [(300, None, 1), (301, "", 0), (302, "tion " * 50_000 + "idiots", 0)]
    docs, labels = frames(spark, rows)
    docs = docs.union(spark.createDataFrame([(None, "no id", "x"), (0, "again", "x")], DOCS))
    labels = labels.union(spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 0), (7, 9)], "doc_id long, toxic int"))
    model = tx.train(docs, labels)
    assert tx.score(docs, model).count() == len(rows) + 2
    kept = tx.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < len(rows)


def test_empty_tables_and_one_label(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs, _ = frames(spark, corpus(20))
    assert {r.score for r in tx.score(docs, tx.train(docs, none)).collect()} == {0.5}
    clean = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert all(r.predicted == 0 for r in tx.score(docs, tx.train(docs, clean)).collect())
    assert tx.score(docs.limit(0), tx.train(docs.limit(0), none)).count() == 0


def test_sentence_swap():
    assert tx.swapped("Men run. Old trees") == {"women", "run", "young", "trees"}
    assert tx.swapped("Trees run") is None and tx.swapped(None) is None


def test_terms_of_another_language_are_swapped_and_counted(spark):
    rows = [(i, t.replace("women", "Frauen").replace("Women", "Frauen"), x) for i, t, x in corpus(seed=3)]
    docs, labels = frames(spark, rows)
    named = sum("Frauen" in t for i, t, _ in rows if not is_held_out(i))
    plain, fair = tx.train(docs, labels), tx.train(docs, labels, terms=(*tx.IDENTITY_TERMS, ("Frauen", "Männer")))
    assert (plain.pairs, fair.pairs) == (0, named) and named > 100

    def gap(model):
        a, b = model.scores(["Die Frauen.", "Die Männer."])
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    assert gap(fair) < 0.3 * gap(plain)


def test_starts_of_words_have_the_features_of_the_words():
    """Identity terms and words that begin like them stay whole; all others are looked up by their longest start."""
    found = {"women", "womenfolk", "african", "africans", "christian", "christianity", "christi", "blesherand", "blesher", "bles", "of", "ß" * 9}
    heads = tx.heads(found)
    assert {f for w in found for f in tx.word_features(w)} == {f for w in heads for f in tx.word_features(w)}
    assert {"african", "africans", "christian", "blesher"} <= heads and "blesherand" not in heads
    many = [f"blesher{i}" for i in range(1000)]
    assert len(tx.heads(many)) == 1
