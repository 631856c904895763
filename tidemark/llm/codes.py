"""Short codes for vectors: per part the nearest entry of a codebook, kept up by distance bounds from round to round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, pick

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Share of the entries that a part keeps bounds of at first.
FIRST_SHARE = 8
# Bounds are kept for as many entries as so many of a hundred parts needed in the round before.
SERVED = 95
# Components beyond this could overflow the integer distances.
LARGEST = 1 << 28
# Distances are rounded; a bound gives way by this much before it decides.
SLACK = 1e-9


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to all entries, as whole numbers."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < 1 << 22:
        # All terms stay below 2^53, so doubles hold them exactly.
        p, q = x.astype(float), entries.astype(float)
        return ((p * p).sum(1)[:, None] + (q * q).sum(1) - 2 * (p @ q.T)).astype(np.int64)
    found = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        found += (x[:, k, None] - entries[None, :, k]) ** 2
    return found


def _below(distance: np.ndarray) -> np.ndarray:
    """The distances as single-precision bounds from below."""
    return np.nextafter(distance.astype(np.float32), np.float32(-np.inf))


class Bounds:
    """Per vector its code in one part, a bound from above for it, the ``b`` next closest entries with bounds from below in ascending order, and one outer bound from below for all others."""

    def __init__(self, n: int, b: int):
        self.code = np.zeros(n, np.int64)
        self.upper = np.full(n, np.inf)
        self.near = np.zeros((n, b), np.int64)
        self.lower = np.full((n, b), -np.inf, np.float32)
        self.outer = np.full(n, -np.inf, np.float32)
        self.needed = np.zeros(n, np.int64)

    @staticmethod
    def kind(parts: int, b: int) -> np.dtype:
        return np.dtype([("code", "u1", parts), ("upper", "<f8", parts), ("near", "u1", (parts, b)), ("lower", "<f4", (parts, b)), ("outer", "<f4", parts)])

    @classmethod
    def read(cls, rows: np.ndarray, part: int, b: int) -> Bounds:
        """One part's bounds; entries beyond the first ``b`` pass into the outer bound."""
        found = cls(len(rows), b)
        found.code[:] = rows["code"][:, part]
        found.upper[:] = rows["upper"][:, part]
        found.near[:] = rows["near"][:, part, :b]
        lower = rows["lower"][:, part]
        found.lower[:] = lower[:, :b]
        found.outer[:] = np.minimum(rows["outer"][:, part], lower[:, b:].min(axis=1, initial=np.inf))
        return found

    def write(self, rows: np.ndarray, part: int) -> None:
        for name in ("code", "upper", "near", "lower", "outer"):
            rows[name][:, part] = getattr(self, name)

    def moved(self, moves: np.ndarray) -> None:
        """Loosen all bounds by how far the entries went."""
        self.upper += moves[self.code] * (1 + SLACK)
        self.lower = _below(self.lower - moves[self.near] * (1 + SLACK))
        self.outer = _below(self.outer - moves.max() * (1 + SLACK))

    def assign(self, x: np.ndarray, entries: np.ndarray) -> None:
        """The nearest entry of every row; of equals the lowest index. Only what the bounds leave open is computed."""
        b = self.near.shape[1]
        # What bounds an entry from below bounds those after it only as their least.
        both = np.concatenate([self.lower, self.outer[:, None]], axis=1)
        least = np.minimum.accumulate(both[:, ::-1], axis=1)[:, ::-1]
        unsure = np.flatnonzero(self.upper * (1 + SLACK) >= least[:, 0])
        if len(unsure):
            exact = np.sqrt(((x[unsure] - entries[self.code[unsure]]) ** 2).sum(axis=1).astype(float))
            self.upper[unsure] = exact
            # Entries whose bound does not rule them out; strictly, so that ties are looked at.
            self.needed[unsure] = (least[unsure] <= (exact * (1 + SLACK))[:, None]).sum(axis=1)
        done = 0
        for most in [*(2**k for k in range(b.bit_length()) if 2**k < b), b] if b else []:
            rows = np.flatnonzero((self.needed > done) & (self.needed <= most))
            done = most
            if len(rows):
                self._among(rows, x[rows], entries, most)
        rows = np.flatnonzero(self.needed > b)
        for at in range(0, len(rows), 4096):
            self._all(rows[at : at + 4096], x[rows[at : at + 4096]], entries)

    def _among(self, rows: np.ndarray, x: np.ndarray, entries: np.ndarray, most: int) -> None:
        """Choose among the present entry and the ``most`` next ones."""
        some = np.concatenate([self.code[rows, None], self.near[rows, :most]], axis=1)
        distance = ((x[:, None, :] - entries[some]) ** 2).sum(axis=2)
        order = np.lexsort((some, distance), axis=1)
        some, distance = np.take_along_axis(some, order, 1), np.take_along_axis(distance, order, 1)
        root = np.sqrt(distance.astype(float))
        self.code[rows], self.upper[rows] = some[:, 0], root[:, 0]
        self.near[rows, :most], self.lower[rows, :most] = some[:, 1:], _below(root[:, 1:])

    def _all(self, rows: np.ndarray, x: np.ndarray, entries: np.ndarray) -> None:
        b = self.near.shape[1]
        distance = squared(x, entries)
        order = np.argsort(distance, axis=1, kind="stable")[:, : b + 2]
        root = np.sqrt(np.take_along_axis(distance, order, 1).astype(float))
        have = min(b, order.shape[1] - 1)
        self.code[rows], self.upper[rows] = order[:, 0], root[:, 0]
        self.near[rows, :have], self.lower[rows, :have] = order[:, 1 : have + 1], _below(root[:, 1 : have + 1])
        self.outer[rows] = _below(root[:, b + 1]) if order.shape[1] > b + 1 else np.float32(np.inf)


def _joined(column: pa.Array, kind: np.dtype | str) -> np.ndarray:
    """Binary values of equal size as rows of numbers."""
    data = b"".join(column.to_pylist())
    found = np.frombuffer(data, kind)
    return found if isinstance(kind, np.dtype) else found.reshape(len(column), -1)


def _assigned(rows: DataFrame, books: np.ndarray, moves: np.ndarray | None, had: int, keep: int) -> DataFrame:
    """``rows`` with bounds and codes for ``books``; without ``moves`` everything is computed."""
    parts, _, width = books.shape
    schema = rows.select(*[c for c in rows.columns if c not in ("state", "needed")]).schema.simpleString()[7:-1].replace(":", " ")

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _joined(batch.column(batch.schema.get_field_index("ints")), "<i4").astype(np.int64)
            old = _joined(batch.column(batch.schema.get_field_index("state")), Bounds.kind(parts, had)) if moves is not None else None
            new = np.zeros(len(x), Bounds.kind(parts, keep))
            needed = np.zeros(len(x), np.int32)
            for part in range(parts):
                own = x[:, part * width : (part + 1) * width]
                if old is None:
                    bounds = Bounds(len(x), keep)
                    bounds.needed[:] = keep + 1
                    for at in range(0, len(x), 4096):
                        bounds._all(np.arange(at, min(at + 4096, len(x))), own[at : at + 4096], books[part])
                else:
                    bounds = Bounds.read(old, part, keep)
                    bounds.moved(moves[part])
                    bounds.assign(own, books[part])
                bounds.write(new, part)
                needed = np.maximum(needed, bounds.needed)
            data, size = new.tobytes(), new.dtype.itemsize
            states = [data[i : i + size] for i in range(0, len(data), size)]
            given = [c for c in batch.schema.names if c not in ("state", "needed")]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in given]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(states, pa.binary()), pa.array(needed.astype(np.int32))], [*given, "state", "needed"])

    return rows.mapInArrow(assign, f"{schema}, state binary, needed int")


def _updated(rows: DataFrame, books: np.ndarray, b: int) -> np.ndarray:
    """The entries as componentwise floor(sum / count) of what they got; unused ones as they were."""
    parts, entries, width = books.shape

    def add(batches):
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _joined(batch.column(0), "<i4").astype(np.int64)
            code = _joined(batch.column(1), Bounds.kind(parts, b))["code"]
            for part in range(parts):
                np.add.at(sums[part, :, :width], code[:, part], x[:, part * width : (part + 1) * width])
                sums[part, :, width] += np.bincount(code[:, part], minlength=entries)
        part, entry = np.nonzero(sums[:, :, width])
        columns = [pa.array(part), pa.array(entry), pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "sums"])

    partial = rows.select("ints", "state").mapInArrow(add, "part long, entry long, sums array<long>")
    summed = partial.groupBy("part", "entry").agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width + 1)])
    found = books.copy()
    # A row per entry at most.
    for row in summed.collect():
        found[row.part, row.entry] = [row[2 + k] // row[2 + width] for k in range(width)]
    return found


def _final(rows: DataFrame, books: np.ndarray, b: int) -> DataFrame:
    parts, _, width = books.shape

    def digest(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _joined(batch.column(2), "<i4").astype(np.int64)
            code = _joined(batch.column(3), Bounds.kind(parts, b))["code"]
            error = np.zeros(len(x), np.int64)
            for part in range(parts):
                error += ((x[:, part * width : (part + 1) * width] - books[part][code[:, part]]) ** 2).sum(axis=1)
            text = [bytes(c).hex() for c in code]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text), pa.array(error)], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "ints", "state").mapInArrow(digest, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def whole_numbers(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """(vec_id, label, v): vectors with finite components only, as floor(scale * component)."""
    given = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = given.where(F.col("x").isNotNull() & usable & (F.size("x") > 0) & (F.size("x") % parts == 0))
    checked = F.transform("x", lambda c: F.when(F.abs(c) * scale <= LARGEST, F.floor(c * scale)).otherwise(
        F.raise_error(F.lit(f"vector component beyond {LARGEST // scale}")).cast("long")))
    return whole.select("vec_id", "label", checked.alias("v"))


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    first_share: int = FIRST_SHARE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector of finite components.

    Components become floor(scale * x); a vector is cut into ``parts``. A
    part's codebook starts as that part of the smallest ids. A round gives
    every part its nearest entry and makes each entry the floored mean of its
    parts. Between rounds a part keeps its closest entries with bounds; after
    the entries moved, only entries whose bound lies within the distance to
    the present one are computed, as whole numbers, so that ties go to the
    lower index as if all had been. The number of entries with bounds falls
    to what 95 of a hundred vectors needed in the round before; a vector
    that needs more compares all.

    NULL vectors, empty ones and those with NULL, NaN or infinite components
    are dropped, and so are vectors whose length is no multiple of ``parts``
    or not that of the smallest kept id. Ids that are NULL come last, repeated
    ids are ordered by their components. With fewer vectors than ``entries``
    the codebooks are as small. A component beyond 2^28 / scale is an error, as the
    integer distances could overflow. Other columns are left behind.
    """
    if entries > 256:
        raise ValueError("codes have one byte a part")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "codes")
    narrow = pick(vectors, vec_id=vec_id, embedding=embedding, label=label).withColumn("vec_id", F.col("vec_id").cast("long"))
    kept = whole_numbers(narrow, parts, scale)
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    shape = kept.orderBy(*order).select(F.size("v").alias("n")).first()
    length = shape.n if shape else parts
    kept = kept.where(F.size("v") == length)
    # As many rows as a codebook has entries.
    first = np.array([r.v for r in kept.orderBy(*order).limit(entries).collect()], np.int64).reshape(-1, parts, length // parts)
    books = np.ascontiguousarray(first.transpose(1, 0, 2))
    count = books.shape[1]

    def squeeze(batches):
        for batch in batches:
            ints = [np.array(v, "<i4").tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ints, pa.binary())], ["vec_id", "label", "ints"])

    kind = kept.schema["label"].dataType.simpleString()
    state = kept.mapInArrow(squeeze, f"vec_id long, label {kind}, ints binary")
    had, moves = 0, None
    keep = max(min(count - 1, 1), count // first_share) if count else 0
    for turn in range(rounds + 1):
        following = scratch.keep(_assigned(state, books, moves, had, keep), "state")
        if turn:
            scratch.drop(state)
        state, had = following, keep
        if turn == rounds:
            break
        changed = _updated(state, books, had)
        moves = np.sqrt(((changed - books) ** 2).sum(axis=2).astype(float))
        books = changed
        if turn:
            # How many vectors needed how many entries: a row per number.
            seen = sorted((r.needed, r["count"]) for r in state.groupBy("needed").count().collect())
            total, so_far = sum(n for _, n in seen), 0
            for needed, n in seen:
                so_far += n
                if so_far * 100 >= total * SERVED:
                    break
            keep = min(keep, max(needed, 1)) if seen else keep
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    found = scratch.keep(_final(state, books, had), "codes")
    scratch.drop(state)
    of_label = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256")
    )
