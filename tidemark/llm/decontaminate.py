"""Documents that hold items of a benchmark, up to a share of edits."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, pick

ERROR_RATE = 0.1
SHORT_ITEM = 30
# Characters of benchmark text that go to the tasks at a time.
BLOCK_CHARS = 4 << 20


def normal(text: str | None) -> str:
    """A-Z in lower case and every run of white space as one space."""
    return " ".join((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass").split())


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed in an item of ``length`` characters; none in short ones."""
    return int(length * rate) if length >= SHORT_ITEM else 0


def pieces(text: str, count: int) -> list[tuple[int, str]]:
    """``count`` consecutive parts of nearly equal length, with where they start."""
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Least edit distance of one item to any part of a text, by Myers' bit vectors."""

    def __init__(self, text: str):
        self.text, self.length = text, len(text)
        self._masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self._masks[c] = self._masks.get(c, 0) | 1 << i

    def distance(self, text: str) -> int:
        full, top = (1 << self.length) - 1, 1 << self.length - 1
        up, down, score = full, 0, self.length
        best = score
        mask = self._masks.get
        for c in text:
            equal = mask(c, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            rise = down | (full & ~(horizontal | up))
            fall = up & horizontal
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
                if score < best:
                    best = score
            rise, fall = rise << 1 & full, fall << 1 & full
            up = fall | (full & ~(vertical | rise))
            down = rise & vertical
        return best


class Matcher:
    """Finds a list of (item_id, normalised text) in normalised texts.

    An item with budget k is split into k + 1 pieces. If a run of pieces holds
    fewer edits than pieces, so does one of its halves, down to a piece without
    edits. So each match shows as an exact hit of a piece from which every
    longer run around it, up to the whole item, can be verified in turn; chance
    hits end at the first short run.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self._items = items
        self._pieces = [pieces(t, budget(len(t), rate) + 1) for _, t in items]
        self._patterns: dict[tuple[int, int, int], Pattern] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for n, parts in enumerate(self._pieces):
            for k, (_, piece) in enumerate(parts):
                where.setdefault(piece, []).append((n, k))
        self._automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self._automaton.add_word(piece, (len(piece), places))
        if where:
            self._automaton.make_automaton()

    def _run(self, n: int, first: int, last: int) -> tuple[int, Pattern]:
        """Where pieces first..last-1 of item n start, and their joined text."""
        key = (n, first, last)
        if key not in self._patterns:
            part = self._pieces[n][first:last]
            self._patterns[key] = Pattern("".join(t for _, t in part))
        return self._pieces[n][first][0], self._patterns[key]

    def _climb(self, text: str, n: int, piece: int, origin: int) -> int | None:
        """Distance of item n near ``origin``, given an exact hit of ``piece``; None where a run fails."""
        path, first, last = [], 0, len(self._pieces[n])
        while last - first > 1:
            path.append((first, last))
            middle = (first + last) // 2
            first, last = (first, middle) if piece < middle else (middle, last)
        distance = 0
        for first, last in reversed(path):
            most = last - first - 1
            start, pattern = self._run(n, first, last)
            low = origin + start - most
            distance = pattern.distance(text[max(0, low) : max(0, low + pattern.length + 2 * most)])
            if distance > most:
                return None
        return distance

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item_id, distance) of every item within its budget, each once with its least distance."""
        if not len(self._automaton):
            return []
        hits: dict[int, set[tuple[int, int]]] = {}
        for end, (size, places) in self._automaton.iter(text):
            for n, piece in places:
                hits.setdefault(n, set()).add((end + 1 - size - self._pieces[n][piece][0], piece))
        found = []
        for n, seen in hits.items():
            item_id, item = self._items[n]
            if any(origin >= 0 and text.startswith(item, origin) for origin in {o for o, _ in seen}):
                found.append((item_id, 0))
                continue
            distances = [d for origin, piece in seen if (d := self._climb(text, n, piece, origin)) is not None]
            if distances:
                found.append((item_id, min(distances)))
        return sorted(found)


def _blocks(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[tuple[bool, list[tuple[int, str]]]]:
    """The items with their normalised texts, in lists of bounded size, each with whether it is the last."""
    wanted = pick(benchmark, item_id=item_id, text=item_text).where("text IS NOT NULL AND item_id IS NOT NULL").distinct()
    chars = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield block == blocks - 1, sorted((r.item_id, t) for r in part.collect() if (t := normal(r.text)))


def _in_turn(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, search) -> DataFrame:
    """``rows`` through ``search(items)`` for each block of the items.

    The result of a block is written before the next one is collected, so the
    driver and a task hold one block at a time. Only the last one stays lazy.
    """
    scratch, before = Scratch(rows.sparkSession, "decontaminate"), None
    for last, items in _blocks(benchmark, item_id, item_text):
        rows = rows.mapInArrow(search(items), rows.schema)
        if not last:
            rows = scratch.keep(rows, "block")
            if before is not None:
                scratch.drop(before)
            before = rows
    return rows


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, contaminated, n_items, items), items as (item_id, distance).

    An item is found where some part of the text is at most
    ``rate`` x its length edits away, both with A-Z lower-cased and white
    space squeezed; items under 30 characters must occur unchanged, and items
    without text are never found. Items with equal text are found together.
    The benchmark is the stated query set: it goes to the tasks in blocks of
    about ``BLOCK_CHARS`` characters, one scan of the texts each, and what a
    block found is written before the next is collected; a single item must fit
    a task. NULL texts count as empty; rows repeat as given; a NULL doc_id stays NULL.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("items", F.array().cast("array<struct<item_id:long,distance:int>>"))
    rows = _in_turn(rows, benchmark, item_id, item_text, lambda items: _search(items, rate))
    return rows.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").alias("n_items"), "items")


def _search(items: list[tuple[int, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate)
        for batch in batches:
            found = [
                [*before, *({"item_id": i, "distance": d} for i, d in matcher.find(normal(text.as_py())))]
                for text, before in zip(batch.column(1), batch.column(2).to_pylist(), strict=True)
            ]
            items_now = pa.array(found, batch.schema.field(2).type)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items_now], batch.schema.names)

    return run


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE
) -> DataFrame:
    """Rows of ``docs`` whose text holds no item, with their own columns; found as by ``find_items``."""

    def search(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text))
                yield batch.filter(pa.array([not matcher.find(normal(t.as_py())) for t in texts], pa.bool_()))

        return run

    return _in_turn(docs, benchmark, item_id, item_text, search)
