import os

import numpy as np
import pytest
import sentencepiece
import test_decontaminate
import test_lines
import test_simhash
import test_toxicity

import corpus_pipeline
from tidemark.llm import decontaminate, toxicity
from tidemark.llm.queries import PIECES, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    items, mixed = test_decontaminate.corpus()
    toxic = test_toxicity.corpus(300)
    texts = [t for _, t, _ in toxic]
    texts += mixed
    texts += [t for _, t, _ in test_lines.corpus() if t is not None]
    texts += ["fresh words that no other text holds at all " + " ".join(f"u{i}x{k}" for k in range(60)) for i in range(5)]
    texts += [texts[-1] + " tail", texts[-2], "", ""]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)] + [(9000, None, None, None, None), (None, "no id at all", "en", "x", 12)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, x, 1 - x) for i, _, x in toxic], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage got and gave."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = os.path.join(str(tmp_path_factory.mktemp("stage")), name)
        stage(spark, docs, sf_dir).write.parquet(out)
        result = spark.read.parquet(out)
        found[name] = (docs.collect(), result.collect(), result.columns)
        docs = result
    return found


def test_columns_and_order(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "piece_encoding"]
    assert all(stages[n][2] == COLUMNS for n in names[:-1])


def test_stage_toxicity(spark, sf_dir, stages):
    given, kept, _ = stages["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = [r for r, s in zip(given, model.scores([r.text for r in given]), strict=True) if s < 0.5]
    assert sorted(kept, key=str) == sorted(want, key=str)
    assert len(kept) < len(given)


def test_stage_line_dedup(stages):
    """What stays of a text are lines of it, and every document stays."""
    given, kept, _ = stages["line_dedup"]
    texts = {r.doc_id: r.text for r in given}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(i for i in texts if i is not None)
    for r in kept:
        rest = iter((texts[r.doc_id] or "").split("\n"))
        assert r.text in (None, "") or all(line in rest for line in r.text.split("\n"))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept)


def test_stage_line_dedup_by_edit_similarity(stages):
    """Of the lines that all pairs by edit similarity alone take out, the stage takes out 95 % and no others."""
    given, kept, _ = stages["line_dedup"]
    rows = [(r.doc_id, r.text, "") for r in given]

    def lines_of(texts):
        return sum(t.count("\n") + 1 for t in texts if t)

    before = lines_of(t for _, t, _ in rows)
    want, within_3_bits = (before - lines_of(t for _, t in f(rows)) for f in (test_lines.by_edit_similarity, test_lines.plain))
    gone = before - lines_of(r.text for r in kept)
    print(f"lines {before}, gone by all pairs {want}, within 3 bits {within_3_bits}, by the stage {gone}")
    assert within_3_bits < 0.95 * want <= gone <= want


def test_stage_simhash_dedup(stages):
    given, kept, _ = stages["simhash_dedup"]
    roots = test_simhash.reachable({r.doc_id: test_simhash.plain_fingerprint(r.text) for r in given if r.doc_id is not None})
    want = [r for r in given if r.doc_id is None or roots[r.doc_id] == r.doc_id]
    assert sorted(kept, key=str) == sorted(want, key=str)
    assert len(kept) < len(given)


def test_stage_decontamination(spark, sf_dir, stages):
    given, kept, _ = stages["decontamination"]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def clean(text):
        text = decontaminate.normal(text)
        return all(test_decontaminate.plain_distance(t, text) > decontaminate.budget(len(t)) for t in items)

    assert sorted(kept, key=str) == sorted((r for r in given if clean(r.text)), key=str)
    assert len(kept) < len(given)


def test_stage_piece_encoding(stages):
    given, found, _ = stages["piece_encoding"]
    own = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    want = sorted((str(r.doc_id), tuple(own.encode(r.text or ""))) for r in given)
    assert sorted((str(r.doc_id), tuple(np.array(r.ids).tolist())) for r in found) == want
    assert all(r.round_trip for r in found)


def test_run(spark, sf_dir, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, stages["piece_encoding"][1]))
