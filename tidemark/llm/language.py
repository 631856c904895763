"""Probability of texts under a language model learned from the corpus itself."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import attention
from tidemark.llm.common import Scratch, fold, pick, worker_state
from tidemark.llm.token_files import ByteBpe
from tidemark.scale import delete_path, tidy_shuffles

HELD_OUT = 1
CHUNK_WORDS = 1 << 22
BLOCK_WORDS = 1 << 17
# Windows worked on at a time: what is computed of them stays in the processor's cache.
BATCH_WINDOWS = 256
# Subwords with an input vector of their own, the most frequent ones; all others share that of their class.
OWN_VECTORS = 2048
# Classes of subwords that start a word and of those inside words, found by the company they keep.
LEAD_CLASSES = 24
INNER_CLASSES = 16
COMPANY = 64
# Least weight of spelling a word out beside the counts of whole words.
LEAST_SPELLED = 0.005
# Weight of the attention model beside the corpus-wide shares of words.
ATTENDED = 0.5
# Training goes through the shards of the texts in so many rounds; a shard has about so many words.
TRAINING_ROUNDS = 4
SHARD_WORDS = 400_000
END = b""

_CHUNK_SCHEMA = (
    "part string, chunk long, doc_id long, held_out boolean, words binary, first int, vocabulary array<binary>,"
    " train array<long>, stream binary"
)


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased words; the end token is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Subwords:
    """Subword ids of a word with the space before it, by a byte-level BPE file."""

    def __init__(self, path: str):
        self._bpe = ByteBpe(path)
        self.size = self._bpe.tokenizer.get_vocab_size()

    def ids(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        return [self._bpe.unit(w.decode("utf-8", "replace")) for w in words]

    def leads(self) -> np.ndarray:
        """Which ids start a word."""
        return np.array([(self._bpe.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(self.size)])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _pack(numbers: np.ndarray) -> bytes:
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data) if data else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _chunks(path: str):
    """Texts to chunks: word numbers per document, a vocabulary with training counts, and the subwords of training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("part", pa.string()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("words", pa.binary()),
            ("first", pa.int32()), ("vocabulary", pa.list_(pa.binary())), ("train", pa.list_(pa.int64())), ("stream", pa.binary()),
        ])
        subwords = worker_state(f"subwords:{path}", lambda: Subwords(path))
        base, made = TaskContext.get().partitionId() << 24, 0
        numbers, held, size = _Numbers(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal numbers, held, size, made
            chunk, made = base + made, made + 1
            end = numbers[END]
            n = len(numbers)

            def counted(texts: list[np.ndarray]) -> np.ndarray:
                counts = np.bincount(np.concatenate([np.zeros(0, np.int32), *texts]), minlength=n)
                counts[end] += len(texts)
                return counts

            used, train = counted([a for *_, a in held]), counted([a for _, _, learn, a in held if learn])
            # Frequent words get small numbers, which pack well.
            order = np.argsort(-used, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            rows = [
                {"part": "text", "chunk": chunk, "doc_id": i, "held_out": out, "words": _pack(rank[np.append(a, end)])}
                for i, out, _, a in held
            ]
            names = list(numbers)
            for at in range(0, n, 8192):
                some = order[at : at + 8192]
                rows.append({"part": "vocabulary", "chunk": chunk, "first": at, "vocabulary": [names[i] for i in some], "train": train[some].tolist()})
            for at in range(0, len(rows), 512):
                yield pa.RecordBatch.from_pylist(rows[at : at + 512], schema)
            for stream in _streams([np.append(a, end) for _, _, learn, a in held if learn], names, subwords):
                yield pa.RecordBatch.from_pylist([{"part": "stream", "chunk": chunk, "stream": _pack(stream)}], schema)
            numbers, held, size = _Numbers(), [], 0

        for batch in batches:
            for i, text, rest in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = tokens(text.as_py())
                learn = rest is not None and rest != HELD_OUT
                held.append((i, rest == HELD_OUT, learn, np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))))
                size += len(words) + 1
                if size >= CHUNK_WORDS:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _streams(texts: list[np.ndarray], names: list[bytes], subwords: Subwords) -> Iterator[np.ndarray]:
    """Subword ids of whole texts given as word numbers, block by block; the id after the last closes each text."""
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *texts]))
    place = np.zeros(len(names), np.int64)
    place[used] = np.arange(len(used))
    pieces = subwords.ids([names[i] for i in used])
    pieces = [p if names[i] else np.array([subwords.size], "<u4").tobytes() for i, p in zip(used, pieces, strict=True)]
    sizes = np.fromiter((len(p) // 4 for p in pieces), np.int64, len(pieces))
    offsets = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(pieces), "<u4")
    held, size = [], 0
    for text in [*texts, None]:
        if held and (text is None or size >= BLOCK_WORDS):
            words = place[np.concatenate(held)]
            first = np.cumsum(sizes[words]) - sizes[words]
            yield flat[np.repeat(offsets[words] - first, sizes[words]) + np.arange(int(sizes[words].sum()))]
            held, size = [], 0
        if text is not None:
            held.append(text)
            size += len(text)


def training_windows(stream: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, place, fresh) of the windows that tile the texts of a stream, as in scoring."""
    starts = np.concatenate([[0], np.nonzero(stream == end)[0] + 1])
    return starts, *attention.windows(starts)


@dataclass
class Model:
    """Everything a task needs to score: classes of subwords, input rows, weights, and corpus totals."""

    known: int
    distinct: int
    singles: int
    classes: np.ndarray
    within: np.ndarray
    inputs: np.ndarray
    words_of_class: np.ndarray
    params: dict[str, np.ndarray] | None = None

    boundary = LEAD_CLASSES + 1
    class_count = LEAD_CLASSES + 1 + INNER_CLASSES
    rows = OWN_VECTORS + class_count + 1

    @property
    def end(self) -> int:
        return len(self.classes) - 1

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.known + 0.5 * (self.distinct + 1)))


def company_classes(company: np.ndarray, weight: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """Class per row of ``company`` (how often a subword shares a window with each frequent one), by spherical k-means."""
    scaled = company / np.sqrt(np.maximum(company.sum(axis=0), 1)) / np.sqrt(np.maximum(company.sum(axis=1, keepdims=True), 1))
    length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    points = np.divide(scaled, length, out=np.zeros_like(scaled), where=length > 0)
    rng = np.random.default_rng(seed)
    order = np.argsort(-weight, kind="stable")[: 8 * count]
    centres = points[rng.permutation(order)[:count]]
    best = np.zeros(len(points), np.int64)
    for _ in range(15):
        best = (points @ centres.T).argmax(axis=1) if len(centres) else best
        for k in range(len(centres)):
            total = (points[best == k] * np.sqrt(weight[best == k])[:, None]).sum(axis=0)
            size = np.sqrt(total @ total)
            if size > 0:
                centres[k] = total / size
    return best


def make_model(counts: np.ndarray, first: np.ndarray, leads: np.ndarray, company: np.ndarray, ends: int, totals: tuple[int, int, int]) -> Model:
    """Classes and what follows from the training counts.

    ``counts`` are those of subword ids, ``first`` of words by their first
    subword. Classes that start a word come first, then that of the end of a
    text, then those inside words. The id after the last stands for the end.
    """
    size = len(counts)
    classes, within = np.zeros(size + 1, np.int64), np.zeros(size + 1)
    weight = counts + 0.5
    for start, members, count in ((0, np.nonzero(leads)[0], LEAD_CLASSES), (LEAD_CLASSES + 1, np.nonzero(~leads)[0], INNER_CLASSES)):
        classes[members] = start + company_classes(company[members], weight[members], count)
    classes[size] = LEAD_CLASSES
    sums = np.bincount(classes[:size], weight, Model.class_count)
    within[:size] = np.log(weight) - np.log(sums[classes[:size]])
    inputs = OWN_VECTORS + classes
    frequent = np.argsort(-counts, kind="stable")[:OWN_VECTORS]
    inputs[frequent] = np.arange(len(frequent))
    words = np.bincount(classes[:size], first, Model.class_count)
    words[LEAD_CLASSES] = ends
    return Model(*totals, classes, within, inputs, words)


def count_company(stream: np.ndarray, number: np.ndarray, seen: np.ndarray) -> None:
    """Adds to ``seen[id, k]`` the windows of ``stream`` in which id stands with the frequent subword that ``number`` calls k."""
    size = len(number)
    _, place, _ = training_windows(stream, size)
    for at in range(0, len(place), BATCH_WINDOWS):
        spots = place[at : at + BATCH_WINDOWS]
        ids = np.sort(np.where(spots < 0, size, stream[spots]), axis=1)
        once = ids < size
        once[:, 1:] &= ids[:, 1:] != ids[:, :-1]
        window, column = np.nonzero(once)
        ids = ids[window, column]
        near = number[ids]
        held = near >= 0
        # Each id of a window beside each frequent one in it; most windows hold few of those.
        sizes = np.bincount(window[held], minlength=len(spots))
        each = sizes[window]
        stops = np.cumsum(each)
        beside = np.arange(each.sum()) + np.repeat((np.cumsum(sizes) - sizes)[window] - stops + each, each)
        np.add.at(seen.reshape(-1), np.repeat(ids * COMPANY, each) + near[held][beside], 1.0)


def _company(frequent: np.ndarray, size: int):
    """(id, k, n): in how many windows id stands with the k-th frequent subword, counted per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(size, -1)
        number[frequent] = np.arange(len(frequent))
        seen = np.zeros((size, COMPANY), np.float64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                count_company(_unpack(data), number, seen)
        ids, ks = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ks), pa.array(seen[ids, ks].astype(np.int64))], ["id", "k", "n"])

    return run


def _texts(end: int):
    """(text,) the subword ids of each training text, as 16-bit numbers where they fit."""
    kind = "<u2" if end < 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                stream = _unpack(data)
                cuts = np.nonzero(stream == end)[0] + 1
                width, whole = np.dtype(kind).itemsize, stream.astype(kind).tobytes()
                texts = [whole[a * width : b * width] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)] if len(cuts) else []
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])

    return run, kind


def _fit(model: Model, kind: str, turn: int):
    """Weights of one shard, from those of the round before; (place, weight x windows, windows).

    The texts of a shard come in the order of their ids, equal ones once with
    their number, so the result does not depend on where they were read.
    """

    def run(shard: pa.Table) -> pa.Table:
        rows = sorted(zip(shard.column("text").to_pylist(), shard.column("n").to_pylist(), strict=True))
        stream = np.frombuffer(b"".join(t for t, _ in rows), kind).astype(np.int64)
        starts, place, fresh = training_windows(stream, model.end)
        of_text = np.searchsorted(starts, place[:, 0], "right") - 1
        weight = fresh * np.array([n for _, n in rows], np.float32)[of_text, None]
        inputs, classes = _inputs(model, stream, starts), model.classes[stream]
        share = 1 / TRAINING_ROUNDS
        seed = int(shard.column("shard")[0].as_py())
        params = attention.train(model.params, inputs[place], classes[place], weight.astype(np.float32), seed, turn * share, share)
        trained, count = attention.flatten(params), float(weight.sum())
        return pa.table({
            "place": pa.array(np.arange(len(trained))), "weighted": pa.array(trained.astype(float) * count),
            "windows": pa.array(np.full(len(trained), count)),
        })

    return run


def _inputs(model: Model, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Input row of each target: that of the subword before it, the last one where a text starts."""
    rows = model.inputs[np.concatenate([[model.end], stream[:-1]])]
    rows[starts[:-1]] = model.rows - 1
    return rows


def _log_probabilities(model: Model, stream: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of P(class of a target | before it), and of P(a word or the end starts here), for all targets."""
    chance, opens = np.zeros(len(stream), np.float32), np.zeros(len(stream), np.float32)
    rows, classes = _inputs(model, stream, starts), model.classes[stream]
    sums = np.ones((model.class_count, 2), np.float32)
    sums[model.boundary :, 1] = 0
    place, fresh = attention.windows(starts)
    for at in range(0, len(place), BATCH_WINDOWS):
        spots, scored = place[at : at + BATCH_WINDOWS], fresh[at : at + BATCH_WINDOWS]
        scores, _ = attention.forward(model.params, rows[spots])
        scores = scores[scored]
        where = spots[scored]
        np.clip(scores, -attention.LARGEST, attention.LARGEST, out=scores)
        picked = scores[np.arange(len(where)), classes[where]]
        # Sums of all classes and of those that open a word, as one product.
        total, opening = (np.exp(scores, out=scores) @ sums).T
        chance[where] = picked - np.log(total)
        opens[where] = np.log(opening / total)
    return chance.astype(float), opens.astype(float)


def score_block(model: Model, texts: list[np.ndarray], counts: np.ndarray, offsets: np.ndarray, flat: np.ndarray) -> list[tuple]:
    """(n_tokens, n_known, base, score) of documents given as word numbers that end with the end token.

    ``counts`` are the training counts of the words, ``flat[offsets[w]:offsets[w+1]]``
    their subwords. Where a word starts, attention gives the chances of its
    class; a known word has its share of all training tokens of the class, or
    is spelled out subword by subword like an unseen one, to where the next
    word may start. The weight of spelling is the share of training tokens
    that occurred once.
    """
    words = np.concatenate(texts)
    word_starts = np.cumsum([0, *map(len, texts)])
    sizes = (offsets[1:] - offsets[:-1])[words]
    first = np.cumsum(sizes) - sizes
    stream = flat[np.repeat(offsets[words] - first, sizes) + np.arange(int(sizes.sum()))]
    starts = np.append(first[word_starts[:-1]], len(stream))
    chance, opens = _log_probabilities(model, stream, starts)
    spelled = np.add.reduceat(chance + model.within[stream], first) - opens[first]
    # A word stops where the next one (or the end of the text) may start.
    stops = np.append(opens[first[1:]], 0.0)
    stops[word_starts[1:] - 1] = 0.0
    spelled += stops
    seen = counts[words]
    share = min(max(LEAST_SPELLED, model.singles / model.known), 0.999) if model.known else 1.0
    with np.errstate(divide="ignore"):
        of_class = seen / np.maximum(model.words_of_class[model.classes[stream[first]]], 1)
        usual = np.log(1 - share) + chance[first] - opens[first] + np.log(of_class)
    base = model.base(seen)
    attended = np.log(ATTENDED) + np.logaddexp(np.log(share) + spelled, usual)
    mixed = np.logaddexp(attended, np.log(1 - ATTENDED) + base * np.log(10)) / np.log(10)
    cuts = word_starts[:-1]
    return list(zip(
        np.diff(word_starts).tolist(), np.add.reduceat((seen > 0).astype(np.int64), cuts).tolist(), np.add.reduceat(base, cuts).tolist(),
        np.add.reduceat(mixed, cuts).tolist(), strict=True,
    ))


def _score(model: Model):
    def run(texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        place = np.asarray(vocabulary.column("place"))
        order = np.argsort(place)
        counts = np.asarray(vocabulary.column("c"))[order]
        pieces = vocabulary.column("pieces").combine_chunks().take(pa.array(order)).to_pylist()
        sizes = np.fromiter((len(p) // 4 for p in pieces), np.int64, len(pieces))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.frombuffer(b"".join(pieces), "<u4").astype(np.int64)
        rows, held, size = [], [], 0
        for data in [*texts.column("words").to_pylist(), None]:
            if held and (data is None or size >= BLOCK_WORDS):
                rows += score_block(model, held, counts, offsets, flat)
                held, size = [], 0
            if data is not None:
                held.append(_unpack(data))
                size += len(held[-1])
        columns = list(zip(*rows, strict=True))
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(columns[0], pa.int64()),
            "n_known": pa.array(columns[1], pa.int64()), "train_tokens": pa.array([model.known] * len(rows), pa.int64()),
            "base_score": pa.array(columns[2], pa.float64()), "score": pa.array(columns[3], pa.float64()),
        })

    return run


def score_texts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), scores in log10.

    Texts are words without A-Z capitals and one end token. Rows of fold 1 of
    crc32(doc_id) are held out, all others are learned from: word counts,
    subword counts, the classes made of them and the attention weights come
    from all training texts. Overlapping windows tile every training text as
    they do in scoring; the weights are trained on all of them, block by block
    in each task from a common start, and averaged over the tasks.

    Each task numbers the words of its texts chunk by chunk, so only the
    distinct words of a chunk are joined with the corpus-wide counts, and a
    chunk is scored where its vocabulary meets its packed texts; chunks have a
    bounded number of words. NULL texts count as empty (one token, the end).
    Rows without doc_id are scored, not learned from, and not held out;
    repeated rows are learned from and scored each.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), "text", fold("doc_id").alias("rest"))
    chunks = scratch.keep(rows.mapInArrow(_chunks(tokenizer), _CHUNK_SCHEMA), "chunks", "part")
    entries = chunks.where("part = 'vocabulary'").select("chunk", "first", F.posexplode(F.arrays_zip("vocabulary", "train")).alias("at", "x"))
    entries = entries.select("chunk", (F.col("first") + F.col("at")).alias("place"), F.col("x.vocabulary").alias("word"), F.col("x.train").alias("n"))

    def with_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = worker_state(f"subwords:{tokenizer}", lambda: Subwords(tokenizer))
        end = np.array([subwords.size], "<u4").tobytes()
        for batch in batches:
            words = batch.column(0).to_pylist()
            packed = [i if w else end for w, i in zip(words, subwords.ids(words), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], ["word", "c", "pieces"])

    totals = entries.groupBy("word").agg(F.sum("n").alias("c")).mapInArrow(with_pieces, "word binary, c long, pieces binary")
    totals = scratch.keep(totals, "totals")
    known, distinct, singles, ends = totals.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1)),
        F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0)),
    ).first()

    def piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = worker_state(f"subwords:{tokenizer}", lambda: Subwords(tokenizer)).size
        counts, starting = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        for batch in batches:
            packed = batch.column(1).to_pylist()
            ids, of_word = np.frombuffer(b"".join(packed), "<u4"), np.asarray(batch.column(0))
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            np.add.at(counts, ids, np.repeat(of_word, sizes))
            np.add.at(starting, ids[np.cumsum(sizes) - sizes], of_word)
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array(starting[some])], ["id", "n", "starting"])

    # One row per subword id, and per id and frequent subword: bounded by the tokenizer.
    with tidy_shuffles(spark):
        found = totals.select("c", "pieces").mapInArrow(piece_counts, "id long, n long, starting long")
        found = found.groupBy("id").agg(F.sum("n").alias("n"), F.sum("starting").alias("starting")).toArrow()
    subwords = Subwords(tokenizer)
    counts, starting = np.zeros(subwords.size + 1), np.zeros(subwords.size + 1)
    counts[np.asarray(found.column("id"))] = np.asarray(found.column("n"))
    starting[np.asarray(found.column("id"))] = np.asarray(found.column("starting"))
    leads = subwords.leads()
    frequent = np.argsort(-np.where(leads, counts[:-1], -1), kind="stable")[:COMPANY]
    streams = chunks.where("part = 'stream'").select("stream")
    with tidy_shuffles(spark):
        met = streams.mapInArrow(_company(frequent, subwords.size), "id long, k long, n long").groupBy("id", "k").agg(F.sum("n").alias("n")).toArrow()
    company = np.zeros((subwords.size, COMPANY))
    company[np.asarray(met.column("id")), np.asarray(met.column("k"))] = np.asarray(met.column("n"))
    model = make_model(counts[:-1], starting[:-1], leads, company, ends, (known, distinct, singles))
    model.params = attention.start(model.rows, model.class_count)
    split, kind = _texts(model.end)
    shards = max(TRAINING_ROUNDS, -(-known // SHARD_WORDS))
    texts = streams.mapInArrow(split, "text binary").withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)))
    texts = scratch.keep(texts.groupBy("shard", "text").agg(F.count("*").alias("n")), "training")
    # The streams are only learned from, and the training texts now hold them.
    delete_path(spark, f"{chunks._tidemark_path}/part=stream")
    for turn in range(TRAINING_ROUNDS):
        part = texts.where(F.col("shard") % TRAINING_ROUNDS == turn)
        with tidy_shuffles(spark):
            fitted = part.groupBy("shard").applyInArrow(_fit(model, kind, turn), "place long, weighted double, windows double")
            # One row per weight: bounded by the model.
            weights = fitted.groupBy("place").agg((F.sum("weighted") / F.sum("windows")).alias("w")).collect()
        flat = attention.flatten(model.params).astype(float)
        for r in weights:
            flat[r.place] = r.w
        model.params = attention.unflatten(flat.astype(np.float32), model.rows, model.class_count)
    scratch.drop(texts)
    resolved = entries.select("chunk", "place", "word").join(totals, "word").select(F.col("chunk").alias("owner"), "place", "c", "pieces")
    packed = chunks.where("part = 'text'").select("chunk", "doc_id", "held_out", "words")
    return packed.groupBy("chunk").cogroup(resolved.groupBy("owner")).applyInArrow(
        _score(model),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
