"""Near-duplicate embeddings: all pairs above a cosine within a label, by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, close_blocks, components, pick
from tidemark.llm.simhash import forest
from tidemark.scale import with_ordinal

MIN_COSINE = 0.98
AXES = 8
# Vectors the axes are fitted on at most; they decide the order and the speed, never a link.
AXES_SAMPLE = 4096
BLOCK = 1024
# Cosines of unit vectors are taken again from the vectors themselves this close to the limit.
_CLOSE_CALL = 1e-9


def _vectors(embeddings: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, scope, vec): the components as double bytes; NULL where the row can link with nothing.

    Only vectors of one label and one length are compared; both make the scope.
    """
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = pick(embeddings, vec_id=vec_id, v=embedding, label=label).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"), "label"
    )
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & ~bad & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("v", F.when(F.coalesce(usable, F.lit(False)), F.col("v")))
    rows = rows.withColumn("scope", F.when(F.col("v").isNotNull(), F.concat_ws(":", F.size("v").cast("string"), F.col("label").cast("string"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Adding zero turns -0.0 into 0.0, so equal vectors have equal bytes.
            packed = [None if not v.is_valid else (np.asarray(v.values, "<f8") + 0.0).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["vec_id", "scope", "vec"])

    return rows.select("vec_id", "scope", "v").mapInArrow(run, "vec_id long, scope string, vec binary")


def unit(vec: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for very large or small components."""
    vec = vec / np.abs(vec).max(axis=1, keepdims=True)
    return vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> np.ndarray:
    """(length, AXES): the leading principal directions of a bounded sample of unit vectors, zero-padded to one length."""
    sample = classes.orderBy(F.xxhash64("vec"), "id").limit(AXES_SAMPLE).select("vec").toArrow().column(0).to_pylist()
    longest = (classes.agg(F.max(F.octet_length("vec"))).first()[0] or 8) // 8
    data = np.zeros((max(1, len(sample)), longest))
    for row, vec in zip(data, sample, strict=False):
        values = np.frombuffer(vec, "<f8")
        row[: len(values)] = unit(values[None])[0]
    axes = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)[2][:AXES].T
    out = np.zeros((longest, AXES))
    out[:, : axes.shape[1]] = axes
    return out


def _project(axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.zeros((batch.num_rows, AXES))
            for row, vec in zip(places, batch.column(1), strict=True):
                values = np.frombuffer(vec.as_py(), "<f8")
                row[:] = unit(values[None])[0] @ axes[: len(values)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(places[:, k]) for k in range(AXES)]], [*batch.schema.names, *[f"p{k}" for k in range(AXES)]]
            )

    return run


def linked(left: np.ndarray, right: np.ndarray, limit: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` have a cosine of at least ``limit``."""
    cosine = unit(left) @ unit(right).T
    found = cosine >= limit
    for i, j in zip(*np.nonzero(np.abs(cosine - limit) <= _CLOSE_CALL), strict=True):
        a, b = left[i], right[j]
        found[i, j] = (a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= limit
    return found


def _compare(limit: float):
    """Per pair of blocks: link counts of every vector (b NULL), and a spanning forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                def side(s: str, row=row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                    ids = np.array(row[f"{s}_ids"])
                    return ids, np.array(row[f"{s}_sizes"]), np.frombuffer(b"".join(row[f"{s}_vecs"]), "<f8").reshape(len(ids), -1)

                (a_ids, a_sizes, a), (b_ids, b_sizes, b) = side("a"), side("b")
                found = linked(a, b, limit)
                if row["a"] == row["b"]:
                    np.fill_diagonal(found, False)
                    counts = {"id": a_ids, "n": found @ b_sizes}
                else:
                    counts = {"id": np.concatenate([a_ids, b_ids]), "n": np.concatenate([found @ b_sizes, found.T @ a_sizes])}
                some = counts["n"] > 0
                x, y = np.nonzero(found)
                edges = forest([(a_ids[x], b_ids[y])])
                ids = [*counts["id"][some].tolist(), *[e[0] for e in edges]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([None] * int(some.sum()) + [e[1] for e in edges], pa.int64()),
                        pa.array(counts["n"][some].tolist() + [None] * len(edges), pa.int64()),
                    ],
                    ["a", "b", "n"],
                )

    return run


def near_duplicates(
    embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", min_cosine: float = MIN_COSINE
) -> DataFrame:
    """One row per row of ``embeddings``: (vec_id, n_links, component_id, kept).

    Vectors link where labels and lengths are equal and the cosine, in double
    precision, is at least ``min_cosine``. Equal vectors become one class with
    a size. Classes are projected on their leading principal axes, sorted by
    the cells of a grid with the width of the largest distance that can link,
    and cut into blocks. A run of blocks keeps the box around it; the sequence
    is joined with itself by intervals, from the whole down to blocks, and
    intervals whose boxes lie further apart than that width are skipped
    (``close_blocks``). Blocks that remain are compared in full; a task hands
    on link counts and a spanning forest, never the pairs.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components,
    and rows without label, link with nothing. Rows without vec_id link with
    nothing and have no component. Every repeated row counts as a vector.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = scratch.keep(_vectors(embeddings, vec_id, embedding, label), "rows")
    classes = scratch.keep(
        rows.where("vec IS NOT NULL").groupBy("scope", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("size")), "classes"
    )
    width = float(np.sqrt(2 - 2 * min_cosine)) + 1e-6
    axes = principal_axes(classes)
    spots = [f"p{k}" for k in range(AXES)]
    projected = classes.select("scope", "vec", "id", "size").mapInArrow(
        _project(axes), "scope string, vec binary, id long, size long, " + ", ".join(f"{p} double" for p in spots)
    )
    cells = [F.floor(F.col(p) / width) for p in spots]
    placed = with_ordinal(projected, ["scope", *cells, "id"], "place", start=0).withColumn("node", F.floor(F.col("place") / BLOCK))
    members = F.sort_array(F.collect_list(F.struct("id", "size", "vec")))
    blocks = scratch.keep(
        placed.groupBy("scope", "node").agg(
            members.alias("m"),
            *[F.min(p).alias(f"low_{p}") for p in spots],
            *[F.max(p).alias(f"high_{p}") for p in spots],
        ),
        "blocks",
    )
    bounds = [f"{side}_{p}" for p in spots for side in ("low", "high")]

    def near(a: str, b: str) -> Column:
        total = F.lit(0.0)
        for p in spots:
            gap = F.greatest(F.col(f"{a}_low_{p}") - F.col(f"{b}_high_{p}"), F.col(f"{b}_low_{p}") - F.col(f"{a}_high_{p}"), F.lit(0.0))
            total = total + gap * gap
        return total <= width * width

    merge = [f(b).alias(b) for b in bounds for f in [F.min if b.startswith("low") else F.max]]
    joined = close_blocks(blocks.select("scope", "node", *bounds), merge, near, scratch)
    for side in "ab":
        joined = joined.join(
            blocks.select(
                "scope", F.col("node").alias(side), F.col("m.id").alias(f"{side}_ids"), F.col("m.size").alias(f"{side}_sizes"),
                F.col("m.vec").alias(f"{side}_vecs"),
            ),
            ["scope", side],
        )
    columns = ["a", "b", *[f"{s}_{c}" for s in "ab" for c in ("ids", "sizes", "vecs")]]
    found = scratch.keep(joined.select(*columns).mapInArrow(_compare(min_cosine), "a long, b long, n long"), "found")
    groups = components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    classes = scratch.keep(
        classes.join(counts, "id", "left").join(groups, classes["id"] == groups["node"], "left").select(
            "scope", "vec", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "results",
    )
    return rows.join(classes, ["scope", "vec"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
