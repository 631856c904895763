"""Encoding and decoding with a piece model file, by a backend rebuilt from its protobuf in the tokenizers library."""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, worker_state
from tidemark.llm.units import UnitCache, runs

MARK = "▁"
THREADS = 2
# Units a worker remembers; memory only.
CACHED = 300_000
# Characters of units, and of texts, that are encoded at a time; an encoded unit takes a few kilobytes.
UNIT_CHARS = 1 << 16
TEXT_CHARS = 1 << 20

# Fixed values of the model file format: kinds of model and of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class PieceModel:
    """What a model file holds: pieces with scores and kinds, and how texts are normalised."""

    kind: int
    pieces: list[tuple[str, float, int]]
    byte_fallback: bool
    unknown_id: int
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    escape: bool
    _scores: dict[str, tuple[float, int]] = field(default_factory=dict)
    _bytes: dict[int, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, rules = model.trainer_spec, model.normalizer_spec
        if trainer.model_type not in (UNIGRAM, BPE) or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"model type {trainer.model_type} or its white space rule is not supported")
        pieces = [(p.piece, p.score, p.type) for p in model.pieces]
        return cls(
            trainer.model_type, pieces, trainer.byte_fallback, next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN),
            rules.precompiled_charsmap, rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces,
        )

    @property
    def whole_units(self) -> bool:
        """Whether a marker only ever starts a piece, and every text starts with one."""
        return self.dummy_prefix and self.escape and not any(
            re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)
        ) and not any(kind == USER_DEFINED for _, _, kind in self.pieces)

    def normaliser(self):
        from tokenizers import Regex, normalizers

        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        return normalizers.Sequence(steps)

    def _merges(self) -> list[tuple[str, str]]:
        """Every pair of pieces that joins to a piece, best joined piece first."""
        rank = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, at in rank.items():
            for cut in range(1, len(piece)):
                if piece[:cut] in rank and piece[cut:] in rank:
                    found.append((-self.pieces[at][1], at, rank[piece[:cut]], rank[piece[cut:]], piece[:cut], piece[cut:]))
        return [(a, b) for *_, a, b in sorted(found)]

    def model(self):
        from tokenizers import models

        if self.kind == UNIGRAM:
            return models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown_id, self.byte_fallback)
        vocabulary = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        unknown = self.pieces[self.unknown_id][0]
        return models.BPE(vocabulary, self._merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)

    def merged(self, text: str) -> list[int]:
        """Ids of one unit, whose neighbours join to the piece of the best score, leftmost first among equals."""
        if not self._scores:
            self._scores.update({p: (-s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)})
            self._bytes.update({int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE})
        signs, after = list(text), list(range(1, len(text) + 1))
        before = [k - 1 for k in range(len(text))]
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = signs[left] + signs[right]
            if joined in self._scores:
                heapq.heappush(queue, (self._scores[joined][0], left, right, joined))

        for k in range(len(text) - 1):
            offer(k, k + 1)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            # One of the two has become part of something else.
            if not signs[left] or not signs[right] or signs[left] + signs[right] != joined or after[left] != right:
                continue
            signs[left], signs[right], after[left] = joined, "", after[right]
            if after[left] < len(text):
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        found: list[int] = []
        for sign in filter(None, signs):
            if sign in self._scores:
                found.append(self._scores[sign][1])
            elif self.byte_fallback:
                found += [self._bytes[b] for b in sign.encode()]
            elif not found or found[-1] != self.unknown_id:
                found.append(self.unknown_id)
        return found

    def backend(self):
        """A tokenizer of the tokenizers library that takes raw texts."""
        from tokenizers import AddedToken, Regex, Tokenizer, pre_tokenizers

        tokenizer = Tokenizer(self.model())
        tokenizer.normalizer = self.normaliser()
        if self.whole_units:
            tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
        tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER_DEFINED])
        return tokenizer

    def units(self, texts: list[str]) -> list[list[str]]:
        """Normalised texts cut before every run of markers; each unit without its first marker."""
        if self.charsmap or self.squeeze:
            rules = self.normaliser()
            texts = [rules.normalize_str(t)[1:].replace(MARK, " ") if t else "" for t in texts]
        out = []
        for text in texts:
            parts = (text.replace(MARK, " ") if MARK in text else text).split(" ")
            if "" in parts:
                parts = [u[1:].replace(" ", MARK) for u in re.findall(" +[^ ]*", " " + " ".join(parts))] if text else []
            out.append(parts)
        return out

    def byte_table(self) -> list[bytes]:
        """What each id stands for."""
        table = []
        for piece, _, kind in self.pieces:
            if kind == BYTE:
                table.append(bytes([int(piece[3:5], 16)]))
            elif kind == UNKNOWN:
                table.append(" ⁇ ".encode())
            else:
                table.append(b"" if kind == CONTROL else piece.replace(MARK, " ").encode())
        return table


class Codec:
    """Encodes and decodes texts by the rebuilt backend; verifies parity with the model's own library, unit by unit."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import Tokenizer

        self.model = PieceModel.read(path)
        self._by_units = self.model.kind == BPE and self.model.whole_units
        self._backend = Tokenizer(self.model.model()) if self._by_units else self.model.backend()
        self._own = sentencepiece.SentencePieceProcessor(model_file=path)
        self._threads = threads
        self._table = self.model.byte_table()
        self._cache = UnitCache(self._encode_units, CACHED)
        self.differing = 0
        self._unlike: set[str] = set()

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids per unit by the rebuilt backend, each compared with the model's own library.

        Both see every distinct unit, so parity is verified on all texts; units
        that differ are remembered, and the texts that hold them reported.
        """
        out = []
        for part in runs(units, len, UNIT_CHARS):
            ours = [e.ids for e in self._backend.encode_batch_fast([MARK + u for u in part], add_special_tokens=False)]
            theirs = self._own.encode(part, num_threads=self._threads)
            for unit, ids, wanted in zip(part, ours, theirs, strict=True):
                if unit.startswith(MARK):
                    # Pieces of blanks alone have equal scores, for which ranked merges know no order.
                    ids = self.model.merged(MARK + unit)
                if unit and ids != wanted:
                    self.differing += 1
                    self._unlike.add(unit)
                out.append(np.array(ids, "<u4").tobytes())
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [ids for ids, _ in self.verified(texts)]

    def verified(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of every text by the backend, and whether the model's own library gives the same."""
        # Sums over a whole text round in the unigram library; merges know no text around a unit.
        if self._by_units:
            units = self.model.units(texts)
            found = [np.frombuffer(b"".join(u), "<u4") for u in self._cache(units)]
            return [(ids, not self._unlike or self._unlike.isdisjoint(u)) for ids, u in zip(found, units, strict=True)]
        ours = [e.ids for e in self._backend.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self._own.encode(texts, num_threads=self._threads)
        self.differing += sum(a != b for a, b in zip(ours, theirs, strict=True))
        return [(np.array(a, "<u4"), a == b) for a, b in zip(ours, theirs, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self._table.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", threads: int = THREADS, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_tokens, ids_crc32, round_trip, parity, ids).

    Whole texts are encoded without markers for begin or end. ``ids_crc32`` is
    over the ids as little-endian unsigned 32-bit integers; ``round_trip``
    tells whether decoding gives the text again (a literal marker character
    comes back as a space); ``parity`` whether the model's own library gives
    the same ids. NULL texts count as empty and have no ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        codec = worker_state(f"pieces:{path}:{threads}", lambda: Codec(path, threads))
        for batch in batches:
            rows = ((i, t.as_py() or "") for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
            for held in runs(rows, lambda r: len(r[1]), TEXT_CHARS):
                texts = [t for _, t in held]
                ids, alike = zip(*codec.verified(texts), strict=True)
                columns = [
                    pa.array([i for i, _ in held], pa.int64()),
                    pa.array(list(map(len, ids)), pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    pa.array([codec.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                    pa.array(alike, pa.bool_()),
                ]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", "parity"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean" + ", ids array<int>" * with_ids
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids; NULL ids give a NULL text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_state(f"pieces:{path}:{THREADS}", lambda: Codec(path, THREADS))
        for batch in batches:
            texts = [codec.decode(np.asarray(x.values, "<u4")) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = pick(encoded, doc_id=doc_id, ids=ids).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
