"""Documents drawn so that their word runs resemble those of a target, by importance weights over hashed features."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, pick
from tidemark.scale import with_ordinal

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
# Bytes of text that a task looks at together.
BATCH_BYTES = 2 << 20
# Words up to so many bytes go through tables, longer ones one by one.
TABLED = 48

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_ONES = np.uint32(0xFFFFFFFF)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(step, ahead): the CRC register after one zero byte, and by (length, byte of the register) after that many."""
    step = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    ahead = np.empty((TABLED + 1, 4, 256), np.uint32)
    ahead[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(TABLED):
        ahead[n + 1] = (ahead[n] >> np.uint32(8)) ^ step[ahead[n] & np.uint32(255)]
    return step, ahead.reshape(-1)


_STEP, _AHEAD = _tables()


class Words:
    """The words of some texts, with what each does to a CRC register."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = _IS_WORD[data]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        self._data, self._start = _LOWER[data], edges[::2]
        self.size = edges[1::2] - edges[::2]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, int)
        self.text = np.searchsorted(starts, self._start, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))
        self._newlines = np.cumsum(data == 10)

    def __len__(self) -> int:
        return len(self.size)

    def lines(self) -> np.ndarray:
        """The line each word stands in, counted over all texts."""
        return self._newlines[self._start]

    def own(self, rows: np.ndarray) -> np.ndarray:
        """Per word the register that its bytes make of an empty one."""
        found = np.zeros(len(rows), np.uint32)
        size, start = self.size[rows], self._start[rows]
        order = np.argsort(-np.minimum(size, TABLED + 1).astype(np.int8), kind="stable")
        ordered = size[order]
        long = int(np.searchsorted(-ordered, -TABLED, "left"))
        state = np.zeros(len(rows) - long, np.uint32)
        begin = start[order[long:]]
        for k in range(int(ordered[long]) if long < len(rows) else 0):
            alive = int(np.searchsorted(-ordered[long:], -k, "left"))
            some = state[:alive]
            state[:alive] = _STEP[(some ^ self._data[begin[:alive] + k]) & np.uint32(255)] ^ (some >> np.uint32(8))
        found[order[long:]] = state
        for row in order[:long]:
            word = self._data[start[row] : start[row] + size[row]].tobytes()
            found[row] = zlib.crc32(word, 0xFFFFFFFF) ^ 0xFFFFFFFF
        return found

    def after(self, state: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The register after the given words, one for each state before."""
        size = self.size[rows]
        base = np.minimum(size, TABLED) * 1024
        found = own.copy()
        for k in range(4):
            found ^= _AHEAD[base + 256 * k + ((state >> np.uint32(8 * k)) & np.uint32(255))]
        for k in np.flatnonzero(size > TABLED):
            found[k] = own[k] ^ zlib.crc32(bytes(int(size[k])), int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        return found

    def spaced(self, state: np.ndarray) -> np.ndarray:
        """The register after one more space."""
        return _STEP[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))


def features(texts: list[bytes], buckets: int, across: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, words): the bucket of every run of 1 to 3 words and the text it is of; the words of each text.

    With ``across`` only the runs whose words stand in several lines of a text.
    """
    words = Words(texts)
    n = len(words)
    every = np.arange(n)
    pair = every[1:][words.text[1:] == words.text[:-1]]
    triple = every[2:][words.text[2:] == words.text[:-2]]
    if across:
        line = words.lines()
        pair, triple = pair[line[pair] != line[pair - 1]], triple[line[triple] != line[triple - 2]]
        used = np.zeros(n, bool)
        for back in range(2):
            used[pair - back] = True
        for back in range(3):
            used[triple - back] = True
        singles = np.flatnonzero(used)
    else:
        singles = every
    own = np.zeros(n, np.uint32)
    own[singles] = words.own(singles)
    state = np.zeros(n, np.uint32)
    state[singles] = words.after(np.full(len(singles), _ONES), singles, own[singles])
    ends = [] if across else [(every, state)]
    # Every third word needs the pair before it, also where that pair itself is no feature here.
    inner = np.union1d(pair, triple - 1) if across else pair
    paired = np.zeros(n, np.uint32)
    paired[inner] = words.after(words.spaced(state[inner - 1]), inner, own[inner])
    ends.append((pair, paired[pair]))
    ends.append((triple, words.after(words.spaced(paired[triple - 1]), triple, own[triple])))
    bucket = np.concatenate([(s ^ _ONES) % np.uint32(buckets) for _, s in ends]).astype(np.int64)
    return bucket, np.concatenate([words.text[rows] for rows, _ in ends]), words.counts


def _encoded(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(rows without the text, texts) of about ``BATCH_BYTES``; the text is the last column."""
    rows, texts, size = [], [], 0
    for batch in batches:
        others = [batch.column(i).to_pylist() for i in range(batch.num_columns - 1)]
        for row, text in zip(zip(*others, strict=True), _encoded(batch.column(batch.num_columns - 1)), strict=True):
            rows.append(row)
            texts.append(text)
            size += len(text)
            if size >= BATCH_BYTES:
                yield rows, texts
                rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def _counted(texts: DataFrame, buckets: int, across: bool = False) -> DataFrame:
    """(bucket, n): occurrences of features over (n, text) rows, each text counting ``n`` times."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for rows, some in _batches(batches):
            bucket, text, _ = features(some, buckets, across)
            times = np.array([r[0] for r in rows], np.int64)
            if (times == 1).all():
                total += np.bincount(bucket, minlength=buckets)
            else:
                np.add.at(total, bucket, times[text])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return texts.select("n", "text").mapInArrow(count, "bucket long, n long")


def _weighed(texts: DataFrame, keys: str, gains: np.ndarray, across: bool) -> DataFrame:
    """The key columns with (words, weight): summed gains of each text's features."""
    names = [k.split()[0] for k in keys.split(", ")]

    def weigh(batches):
        for rows, some in _batches(batches):
            bucket, text, words = features(some, len(gains), across)
            weight = np.zeros(len(some), np.int64)
            np.add.at(weight, text, gains[bucket])
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words.astype(np.int64)), pa.array(weight)], [*names, "words", "weight"])

    return texts.select(*names, "text").mapInArrow(weigh, f"{keys}, words long, weight long")


def _summed(counts: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences per bucket; ``buckets`` rows at most reach the driver."""
    found = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln) of how much likelier a feature of it is in the target than in the source."""
    n = len(source)
    t_all, s_all = float(target.sum() + n), float(source.sum() + n)
    ratio = [(float(t + 1) * s_all) / (float(s + 1) * t_all) for t, s in zip(target.tolist(), source.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, target: DataFrame, scratch: Scratch, buckets: int) -> DataFrame:
    """(doc_id, tie, words, weight, copies): words and summed gains of every text of (doc_id, tie, text).

    Texts are cut at their newlines, which separate words anyway. Features
    inside a line are counted and weighed once per distinct line; the runs of
    words that reach over the end of a line are added from the texts.
    """
    cut = docs.select("doc_id", "tie", F.explode(F.split("text", "\n")).alias("text")).where("text <> ''")
    lines = scratch.keep(cut.groupBy("text").agg(F.count("*").alias("n")), "lines", codec="zstd")
    once = F.lit(1).cast("long").alias("n")
    source = _counted(lines, buckets).union(_counted(docs.select(once, "text"), buckets, across=True))
    value = gains(_summed(_counted(target.select(once, "text"), buckets), buckets), _summed(source, buckets))
    key = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("line"), F.col("text")).alias("k2")]
    of_line = _weighed(lines.select(*key, "text"), "k1 long, k2 long", value, across=False)
    within = cut.select("doc_id", "tie", *key).join(of_line, ["k1", "k2"]).select("doc_id", "tie", F.lit(0).alias("words"), "weight", F.lit(0).alias("copies"))
    over = _weighed(docs, "doc_id long, tie long", value, across=True).select("doc_id", "tie", "words", "weight", F.lit(1).alias("copies"))
    sums = over.union(within).groupBy("doc_id", "tie").agg(*[F.sum(c).alias(c) for c in ("words", "weight", "copies")])
    # Rows of one id and text were summed together.
    return sums.withColumns({c: F.expr(f"{c} div copies") for c in ("words", "weight")})


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): documents drawn without replacement by their importance for ``target``.

    Features are runs of 1 to 3 words (A-Z in lower case, parted by ASCII
    characters other than letters and digits), hashed to ``buckets``. A
    document's weight is the sum of its features' gains, the score adds Gumbel
    noise from a hash of the id. Of the documents with ``least_words`` words
    or more, ``percent`` of a hundred with the highest scores get the ranks
    1, 2, 3…; ties go to the smaller id, then to a hash of the text.

    NULL texts have no words. Rows without doc_id have features and weight,
    but no score and are never drawn. Repeated rows are weighed one by one; an
    id that repeats has one noise, so its rows tie where their weights do.
    Other columns are left behind. An empty target gives the gains of no
    features at all.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resampling")
    texts = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), texts.alias("text"))
    narrow = narrow.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    found = weights(narrow, pick(target, text=text).select(texts.alias("text")), scratch, buckets)
    noise = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    scored = found.select(
        "doc_id", "tie", "words", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        F.expr("words + greatest(words - 1, 0) + greatest(words - 2, 0)").alias("n_features"), "weight",
        (F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(noise)))).alias("score"),
    )
    scored = scratch.keep(scored, "scored")
    able = (F.col("words") >= least_words) & F.col("doc_id").isNotNull()
    drawn = scored.where(able).count() * percent // 100
    ranked = with_ordinal(scored.where(able), [F.col("score").desc(), "doc_id", "tie", "copy"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
