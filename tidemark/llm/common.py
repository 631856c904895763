"""Parts shared by the operators: scratch tables, connected components, joins of a node hierarchy with itself."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scale import delete_path, scratch_path, tidy_shuffles


class Scratch:
    """Tables an operator writes for itself in the shared folder.

    ``keep`` writes a frame and reads it back, which cuts its lineage.
    ``drop`` deletes tables that nothing reads any more; what a returned frame
    still reads stays, as Spark evaluates it later.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self._next = spark, scratch_path(spark, name), 0

    def folder(self, name: str) -> str:
        self._next += 1
        return f"{self.path}/{self._next}-{name}"

    def keep(self, df: DataFrame, name: str, *partition_by: str, codec: str = "snappy") -> DataFrame:
        path = self.folder(name)
        writer = df.write.option("compression", codec)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with tidy_shuffles(self.spark):
            writer.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._tidemark_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            delete_path(self.spark, df._tidemark_path)


def _return_memory() -> None:
    """Give what is free in this process back to the system, which the next operator in it would not reuse."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def worker_state(key: str | None, make: Callable = lambda: None):
    """The one value a worker process keeps for its later tasks; another key takes the place of the last.

    Without a key the process only lets go of what it keeps, so the memory of
    one operator is free before the next one works in the same process.
    """
    registry = sys.modules.setdefault("_tidemark_worker_state", types.ModuleType("_tidemark_worker_state"))
    if getattr(registry, "key", "") != key:
        registry.key = registry.value = None
        _return_memory()
        registry.key, registry.value = key, make()
    return registry.value


# Rows up to which a narrow table may be sent to every task.
SENT_ROWS = 2_000_000


def small_side(df: DataFrame) -> DataFrame:
    """``df``, a kept table of a few numbers a row, marked for broadcast where its counted rows are few enough.

    Above the bound the join shuffles instead; the result is the same.
    """
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; any others are left behind."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids give NULL."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating star contraction: every node first points its larger
    neighbours, then its smaller ones, at the smallest node it knows, until
    nothing changes. Minima are aggregates and the joins are plain equi-joins,
    so a hub with very many neighbours is combined on the map side and split
    by the skew handling; no group is collected.
    """
    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    current = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = stamp(current)
    while before[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        target = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(target, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(target.select("u", F.col("m").alias("v"))).distinct()
        )
        following = scratch.keep(small, "edges")
        after = stamp(following)
        scratch.drop(current)
        current = following
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def close_blocks(
    leaves: DataFrame,
    merge: list[Column],
    near: Callable[[str, str], Column],
    scratch: Scratch,
    fanout: int = 64,
) -> DataFrame:
    """Pairs (scope, a, b) of leaves with a <= b that ``near`` cannot tell apart.

    ``leaves`` holds (scope, node, summary…) with nodes numbered from 0 in
    sort order. Runs of ``fanout`` neighbours get an upper node with the merged
    summary, level by level, up to one node. The pairs start at the top and
    are only followed into children while ``near(left, right)`` holds, so a
    provably distant pair of groups ends the search for all below it.
    """
    summary = [c for c in leaves.columns if c not in ("scope", "node")]
    levels = [scratch.keep(leaves, "nodes")]
    while levels[-1].agg(F.max("node")).first()[0]:
        above = (
            levels[-1].withColumn("node", F.floor(F.col("node") / fanout)).groupBy("scope", "node").agg(*merge)
        )
        levels.append(scratch.keep(above, "nodes"))
    pairs = levels[-1].select("scope", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        def children(side: str, level=level) -> DataFrame:
            return level.select(
                "scope",
                F.floor(F.col("node") / fanout).alias(f"{side}_up"),
                F.col("node").alias(side),
                *[F.col(c).alias(f"{side}_{c}") for c in summary],
            )

        found = (
            pairs.withColumnsRenamed({"a": "a_up", "b": "b_up"})
            .join(children("a"), ["scope", "a_up"])
            .join(children("b"), ["scope", "b_up"])
            .where((F.col("a") <= F.col("b")) & near("a", "b"))
        )
        pairs = scratch.keep(found.select("scope", "a", "b"), "pairs")
    return pairs
