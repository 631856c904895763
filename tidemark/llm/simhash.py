"""Near-duplicate documents by SimHash and a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, close_blocks, components, pick, small_side
from tidemark.scale import with_ordinal

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCK = 1024
GROUP = 32
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of all word shingles of ``text``; 0 where there is no word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[start : start + _HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, code): the signed 64-bit fingerprint of every row; a NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64())], ["doc_id", "code"])

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, code long")


def gray_rank(code: Column) -> Column:
    """Position of a code in Gray order, as a signed number that sorts like the unsigned one."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _shared(codes: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Per run of ``group`` codes: the mask of bits all agree on, and their pattern."""
    starts = np.arange(0, len(codes), group)
    low, high = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    return ~(low ^ high), low


def close_codes(left: np.ndarray, right: np.ndarray, max_bits: int, group: int = GROUP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in left, in right) of codes at most ``max_bits`` apart, for Gray-ordered blocks.

    Both blocks get a lower level of masked patterns; only pairs of runs whose
    shared bits differ little enough are compared code by code.
    """
    (left_mask, left_bits), (right_mask, right_bits) = _shared(left, group), _shared(right, group)
    apart = np.bitwise_count((left_bits[:, None] ^ right_bits) & left_mask[:, None] & right_mask)
    for i, j in zip(*np.nonzero(apart <= max_bits), strict=True):
        a, b = left[i * group : (i + 1) * group], right[j * group : (j + 1) * group]
        x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b) <= max_bits)
        if len(x):
            yield x + i * group, y + j * group


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that connect the same numbers as all ``pairs`` do, fewer than there are numbers."""
    parent: dict[int, int] = {}
    kept = []

    def root(n: int) -> int:
        while parent.setdefault(n, n) != n:
            parent[n] = n = parent[parent[n]]
        return n

    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                kept.append((x, y))
    return kept


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for row in range(batch.num_rows):
                (a, a_ids), (b, b_ids) = (
                    tuple(np.asarray(batch.column(f"{side}_{part}")[row].values) for part in ("codes", "ids")) for side in "ab"
                )
                named = ((a_ids[x], b_ids[y]) for x, y in close_codes(a.view(np.uint64), b.view(np.uint64), max_bits))
                for x, y in forest(named):
                    out_a.append(x)
                    out_b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fingerprint, component_id, code).

    Distinct fingerprints are sorted by Gray rank and cut into blocks. A block
    keeps the bits all its codes share as a masked pattern; runs of blocks get
    upper nodes, whose patterns only shrink, so the differing shared bits of
    two nodes bound those of all codes below and whole groups are pruned
    (``close_blocks``). The blocks left are compared inside tasks, again by
    masked patterns first. Per pair of blocks only a spanning forest of the
    links leaves the task: groups of any size never become all their pairs.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id``
    is the smallest doc_id reachable. Texts that are NULL, empty or blank have
    fingerprint zero and link like any other. Repeated rows give repeated
    results. Rows without doc_id keep a fingerprint and have no component.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    prints = scratch.keep(fingerprints(docs, doc_id, text, words), "prints")
    codes = prints.where("doc_id IS NOT NULL").groupBy("code").agg(F.min("doc_id").alias("id"))
    placed = with_ordinal(codes.withColumn("rank", gray_rank(F.col("code"))), ["rank"], "place", start=0)
    blocks = scratch.keep(
        placed.groupBy(F.floor(F.col("place") / BLOCK).alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("place", "code", "id"))).alias("members")
        ).select("node", F.col("members.code").alias("codes"), F.col("members.id").alias("ids")),
        "blocks",
    )
    leaves = blocks.select(
        F.lit(0).alias("scope"),
        "node",
        F.aggregate("codes", F.lit(-1).cast("long"), lambda x, y: x.bitwiseAND(y)).alias("low"),
        F.aggregate("codes", F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y)).alias("high"),
    )

    def near(a: str, b: str) -> Column:
        def mask(side: str) -> Column:
            return F.bitwise_not(F.col(f"{side}_low").bitwiseXOR(F.col(f"{side}_high")))

        differing = F.col(f"{a}_low").bitwiseXOR(F.col(f"{b}_low")).bitwiseAND(mask(a)).bitwiseAND(mask(b))
        return F.bit_count(differing) <= max_bits

    merge = [F.bit_and("low").alias("low"), F.bit_or("high").alias("high")]
    pairs = close_blocks(leaves, merge, near, scratch)
    # A row holds two whole blocks; each task takes an equal share of such rows.
    joined = pairs
    for side in "ab":
        joined = joined.join(
            blocks.select(F.col("node").alias(side), F.col("codes").alias(f"{side}_codes"), F.col("ids").alias(f"{side}_ids")), side
        )
    links = joined.select("a_codes", "a_ids", "b_codes", "b_ids").mapInArrow(_links(max_bits), "a long, b long")
    groups = components(links, scratch)
    classes = scratch.keep(
        codes.join(groups, codes["id"] == groups["node"], "left").select(
            "code", F.coalesce("component", "id").alias("component_id")
        ),
        "classes",
    )
    return prints.join(classes, "code", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        "code",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` whose document is the smallest of its near-duplicate group, plus rows without id."""
    found = near_duplicates(docs, doc_id, text, words, max_bits)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    dropped = small_side(Scratch(docs.sparkSession, "simhash").keep(dropped, "dropped"))
    return docs.join(dropped, docs[doc_id] == dropped["_dropped"], "left_anti")
