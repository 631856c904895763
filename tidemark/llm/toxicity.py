"""Toxicity of texts: a linear classifier trained to score a sentence alike whoever it is about."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, fold, pick, small_side, worker_state
from tidemark.llm.units import UnitTable

# Word starts of these lengths are the features; a shorter word is one by itself.
STARTS = (4, 5, 7)
FEATURES = 4096
LEAST_DOCS = 5
# Labelled rows the weights are fitted on, as expected number: a share of all of them by a hash of the row.
TRAIN_ROWS = 20_000
RIDGE = 1e-5
COUNTERFACTUAL = 1.0
STEPS = 400
RATE = 0.3

# Identity terms in sets of exchangeable ones.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "arab"),
    ("immigrants", "natives"),
    ("old", "young"),
    ("disabled", "abled"),
)
Terms = tuple[tuple[str, ...], ...]


def swaps_of(terms: Terms) -> dict[str, str]:
    """The next term of its set for every term, in lower case."""
    return {term.lower(): group[(i + 1) % len(group)].lower() for group in terms for i, term in enumerate(group)}


SWAPS = swaps_of(IDENTITY_TERMS)

# Words or starts of words whose features a task remembers; memory only.
CACHED_WORDS = 200_000
# Texts whose features are counted together; Spark adds the counts up.
COUNTED_ROWS = 2_000

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_features(word: str, swaps: dict[str, str] = SWAPS) -> tuple[int, ...]:
    """Signed 64-bit hashes of the starts of a word; an identity term is a feature of its own alone."""
    if word in swaps:
        return (_hash("=" + word),)
    return tuple({_hash(word[:n]) for n in STARTS})


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def heads(found: Iterable[str], swaps: dict[str, str] = SWAPS) -> set[str]:
    """What the features of words follow from: their longest start, or the whole word where an identity term starts alike."""
    terms = {term[: STARTS[-1]] for term in swaps}
    return {word if (start := word[: STARTS[-1]]) in terms else start for word in found}


def features(found: set[str], known: UnitTable) -> set[int]:
    out: set[int] = set()
    out.update(*map(known.__getitem__, found))
    return out


def swapped(text: str | None, swaps: dict[str, str] = SWAPS) -> set[str] | None:
    """Words of the text with every identity term replaced by the next of its set; None without such terms.

    Only the sentences that name a group change.
    """
    found = words(text)
    if not any(w in swaps for w in found):
        return None
    out: set[str] = set()
    for sentence in _SENTENCE.findall((text or "").lower()):
        out.update(swaps.get(w, w) for w in _WORD.findall(sentence))
    return out


@dataclass
class Model:
    weights: dict[int, float]
    bias: float
    terms: Terms = IDENTITY_TERMS
    # Training texts with an identity term, whose swapped twins the penalty compares them with.
    pairs: int = 0

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """Probability of label 1 for every text; NULL counts as empty."""
        swaps = swaps_of(self.terms)
        known = UnitTable(lambda word: tuple(f for f in word_features(word, swaps) if f in self.weights), CACHED_WORDS)
        out = []
        for text in texts:
            seen: set[int] = set()
            seen.update(*map(known.__getitem__, heads(words(text), swaps)))
            z = self.bias + sum(self.weights[f] for f in sorted(seen))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
        return out


def feature_counts(rows: DataFrame, swaps: dict[str, str] = SWAPS) -> DataFrame:
    """(feature, docs, toxic_docs) over all labelled rows (text, toxic); counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(None)
        known = UnitTable(lambda word: word_features(word, swaps), CACHED_WORDS)
        for batch in (b.slice(at, COUNTED_ROWS) for b in batches for at in range(0, b.num_rows, COUNTED_ROWS)):
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[int(toxic == 1)].update(features(heads(words(text.as_py()), swaps), known))
            both = sorted(set(counts[0]) | set(counts[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(both, pa.int64()),
                    pa.array([counts[0][f] + counts[1][f] for f in both], pa.int64()),
                    pa.array([counts[1][f] for f in both], pa.int64()),
                ],
                ["feature", "docs", "toxic_docs"],
            )

    partial = rows.select("text", "toxic").mapInArrow(run, "feature long, docs long, toxic_docs long")
    return partial.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("toxic_docs").alias("toxic_docs"))


def select_features(counts: DataFrame, docs: int, toxic: int, limit: int = FEATURES) -> list[int]:
    """The features that depend most on the label, by chi-squared over all labelled rows."""
    a, b = F.col("toxic_docs").cast("double"), (F.col("docs") - F.col("toxic_docs")).cast("double")
    n, t = float(docs), float(toxic)
    below = F.col("docs").cast("double") * (n - F.col("docs")) * t * (n - t)
    chi = F.pow(a * (n - t) - b * t, 2) * n / F.greatest(below, F.lit(1.0))
    kept = counts.where(F.col("docs") >= LEAST_DOCS).select("feature", chi.alias("chi"))
    return [r.feature for r in kept.orderBy(F.desc("chi"), "feature").limit(limit).collect()]


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.repeat(np.arange(len(rows)), sizes), np.fromiter((f for r in rows for f in r), np.int64, int(sizes.sum()))


def fit(rows: list[list[int]], labels: list[int], twins: list[list[int] | None], size: int) -> tuple[np.ndarray, float]:
    """Logistic regression over present features, minimising

        log loss + COUNTERFACTUAL x mean((z(text) - z(twin))^2) + RIDGE x |w|^2

    where a twin is the text with its identity terms swapped.
    """
    y = np.asarray(labels, float)
    row, col = _sparse(rows)
    paired = [i for i, t in enumerate(twins) if t is not None]
    gap_row, gap_col, gap_sign = [], [], []
    for k, i in enumerate(paired):
        for sign, side in ((1.0, set(rows[i]) - set(twins[i])), (-1.0, set(twins[i]) - set(rows[i]))):
            for f in side:
                gap_row.append(k)
                gap_col.append(f)
                gap_sign.append(sign)
    gap_row, gap_col, gap_sign = np.array(gap_row, np.int64), np.array(gap_col, np.int64), np.array(gap_sign)
    w, bias = np.zeros(size), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    first, second, at = np.zeros(size + 1), np.zeros(size + 1), 0
    for at in range(1, STEPS + 1):
        z = bias + np.bincount(row, w[col], len(y))
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(y)
        slope = np.bincount(col, off[row], size) + 2 * RIDGE * w
        if paired:
            gap = np.bincount(gap_row, w[gap_col] * gap_sign, len(paired))
            slope += 2 * COUNTERFACTUAL / len(paired) * np.bincount(gap_col, gap[gap_row] * gap_sign, size)
        full = np.append(slope, off.sum())
        first, second = 0.9 * first + 0.1 * full, 0.99 * second + 0.01 * full**2
        step = RATE * (1 - at / (STEPS + 1)) * (first / (1 - 0.9**at)) / (np.sqrt(second / (1 - 0.99**at)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", held_out: int = 0,
    terms: Terms = IDENTITY_TERMS,
) -> Model:
    """A model learned from the labelled rows outside fold ``held_out`` of crc32(doc_id).

    Statistics that choose the features come from all of those rows; the
    weights are fitted on about ``TRAIN_ROWS`` of them at most. Only the text is an
    input. Ids labelled more than once count as toxic if one label says so;
    rows without label, id or fold are not learned from. Without labelled rows
    of both kinds the score is the share of toxic ones everywhere.

    ``terms`` are sets of exchangeable identity terms in any languages, single
    words; ``pairs`` of the model counts the texts that held one. With none
    the model is plain logistic regression.
    """
    swaps = swaps_of(terms)
    scratch = Scratch(docs.sparkSession, "toxicity")
    marks = pick(labels, mark_id=doc_id, toxic=label).where("mark_id IS NOT NULL AND toxic IN (0, 1)")
    marks = marks.where(fold("mark_id") != held_out).groupBy("mark_id").agg(F.max("toxic").alias("toxic"))
    rows = pick(docs, doc_id=doc_id, text=text)
    marks = small_side(scratch.keep(marks, "marks"))
    rows = rows.join(marks, rows["doc_id"] == marks["mark_id"]).select("doc_id", "text", "toxic")
    rows = scratch.keep(rows, "labelled")
    n, t = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not n or t in (0, n):
        scratch.drop(rows)
        return Model({}, float(np.log(((t or 0) + 0.5) / (n - (t or 0) + 0.5))), terms)
    chosen = select_features(feature_counts(rows, swaps), n, t)
    place = {f: i for i, f in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = UnitTable(lambda word: word_features(word, swaps), CACHED_WORDS)

            def indices(found: set[str] | None, known=known) -> list[int] | None:
                return None if found is None else sorted(place[f] for f in features(found, known) if f in place)

            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([indices(set(words(x))) for x in texts], pa.list_(pa.int32())),
                    pa.array([indices(swapped(x, swaps)) for x in texts], pa.list_(pa.int32())),
                    batch.column(1).cast(pa.int32()),
                ],
                ["present", "twin", "toxic"],
            )

    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) < TRAIN_ROWS
    sample = rows.where(share).select("text", "toxic")
    found = sample.mapInArrow(run, "present array<int>, twin array<int>, toxic int").toArrow()
    weights, bias = fit(*(found.column(c).to_pylist() for c in ("present", "toxic", "twin")), len(chosen))
    scratch.drop(rows)
    pairs = len(found) - found.column("twin").null_count
    return Model({f: float(weights[i]) for f, i in place.items() if weights[i]}, bias, terms, pairs)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted). Empty and NULL texts get a score too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(None)
        for batch in batches:
            scores = model.scores(t.as_py() for t in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_civil(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` the model does not reject, with their own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(None)
        for batch in batches:
            scores = model.scores(t.as_py() for t in batch.column(batch.schema.get_field_index(text)))
            yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
