"""Numbers of pieces under a unigram vocabulary, without the pieces themselves."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, worker_state
from tidemark.llm.pieces import BYTE, MARK, NORMAL, USER_DEFINED, PieceModel
from tidemark.llm.units import UnitTable, runs

# Fixed value of the tokenizer: what an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


class Counter:
    """Counts the pieces of the best segmentation of a text.

    The scores of a vocabulary file are read as unigram scores and summed in
    double precision. An Aho-Corasick automaton lists all pieces that end at a
    position; the best score and its number of pieces are carried along. Of
    equally good segmentations the one whose last piece starts first counts; a
    character that is no piece by itself may stand alone as unknown if that is
    strictly better. Unknown characters count their bytes with byte fallback,
    else a run of them counts once.
    """

    def __init__(self, path: str):
        self.model = PieceModel.read(path)
        scored = [(p, s) for p, s, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED)]
        self._unknown = min(s for _, s in scored) - UNKNOWN_PENALTY
        bytes_known = sum(kind == BYTE for _, _, kind in self.model.pieces) == 256
        self._by_bytes = self.model.byte_fallback and bytes_known
        self._automaton = ahocorasick.Automaton()
        for piece, score in scored:
            self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._cache = UnitTable(lambda unit: self.pieces(MARK + unit))

    def pieces(self, text: str) -> int:
        """Number of pieces of one normalised text."""
        ending: list[list[tuple[int, float]]] = [[] for _ in text]
        for end, match in self._automaton.iter(text):
            ending[end].append(match)
        scores, counts, unknown = [0.0], [0], [False]
        for end, matches in enumerate(ending, 1):
            best, size, alone = None, 0, False
            for length, score in matches:
                alone = alone or length == 1
                total = scores[end - length] + score
                if best is None or total > best or (total == best and length > size):
                    best, size = total, length
            total = scores[end - 1] + self._unknown
            if not alone and (best is None or total > best):
                scores.append(total)
                more = len(text[end - 1].encode("utf-8", "surrogatepass")) if self._by_bytes else int(not unknown[end - 1])
                counts.append(counts[end - 1] + more)
                unknown.append(True)
            else:
                scores.append(best)
                counts.append(counts[end - size] + 1)
                unknown.append(False)
        return counts[-1]

    def counts(self, texts: list[str]) -> list[int]:
        if self.model.whole_units:
            return [sum(map(self._cache.__getitem__, units)) for units in self.model.units(texts)]
        rules = self.model.normaliser()
        return [self.pieces(rules.normalize_str(t)) if t else 0 for t in texts]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_tokens). NULL and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(f"counts:{path}", lambda: Counter(path))
        for batch in batches:
            found: list[int] = []
            for held in runs([t or "" for t in batch.column(1).to_pylist()], len, 4 << 20):
                found += counter.counts(held)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "n_tokens"])

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")
