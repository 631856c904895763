"""Helpers that keep operators whole and spread at any data size."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_POSITION_BITS = 33
_LOCAL_FOLDERS: dict[str, str] = {}
# Scratch paths made in each open scope.
_SCOPES: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own, which
    goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused between runs."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was written to new scratch paths within it.

    Results are evaluated later and may still read such copies (numbered rows,
    cut lineages), so they are to be written out before the scope ends.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_path(spark, path)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [status.getPath().toString() for status in found or []]


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    if not paths[0].getFileSystem(spark._jsc.hadoopConfiguration()).rename(*paths):
        raise OSError(f"cannot rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete under its name or not there."""
    draft = f"{path}.draft"
    target = spark._jvm.org.apache.hadoop.fs.Path(draft)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    delete_path(spark, path)
    rename_path(spark, draft, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a finished write go at once, not only when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


# What opening a file costs beside its bytes, in bytes read, and the tasks that list the folders of a folder.
_SMALL_FILES = {"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256"}


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Within it small files share a task, and so do folders that are listed.

    By Spark's own settings a folder of tens of thousands makes as many
    thousands of tasks, which the driver holds, and of files where it is cut
    into pieces again. Files as large as a task are read as before.
    """
    before = {key: spark.conf.get(key) for key in _SMALL_FILES}
    try:
        for key, value in _SMALL_FILES.items():
            spark.conf.set(key, str(min(int(value), _bytes(before[key]))))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes(size: str) -> int:
    """A number with or without a unit, as Spark's settings have them."""
    number, unit = size.strip().lower().rstrip("b"), 0
    if number[-1:] in "kmgtp":
        number, unit = number[:-1], 10 * (1 + "kmgtp".index(number[-1]))
    return int(number) << unit


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on how its input was computed, so values such
    as partition numbers stay the same when an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    with tidy_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows that make a task where each is heavy to work on.
HEAVY_ROWS = 1000


def spread(df: DataFrame, *cols: str | Column, rows: int | None = None, per_task: int = HEAVY_ROWS) -> DataFrame:
    """Rows dealt anew, about ``per_task`` to a task, ahead of work that is heavy per row.

    The number of tasks follows the number of rows, counted here unless given:
    the size of rows still narrow says nothing about the work to come.
    """
    count = df.count() if rows is None else rows
    return df.repartition(max(1, -(-count // per_task)), *[F.col(c) if isinstance(c, str) else c for c in cols])


def packed_order(major: Column, minor: Column) -> Column:
    """One sortable number for (``major``, ``minor``), both whole numbers.

    ``min_by``/``max_by`` over a struct fall back to sort-based aggregation;
    a decimal keeps the hash aggregate. ``minor`` must lie in [0, 10^19) and
    ``major`` needs at most 18 digits.
    """
    return major.cast("decimal(18,0)") * F.lit(Decimal(10**19)) + minor.cast("decimal(20,0)")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def with_ordinal(df: DataFrame, order: list[str | Column], name: str = "ordinal", start: int = 1) -> DataFrame:
    """Number rows ``start, start+1, …`` in the given total order.

    Rows are range-partitioned, sorted per partition and shifted by the row
    counts of the partitions before, so no task sees more than its own range.
    The sorted rows are written to the shared folder first: the numbers depend
    on where each partition ends, which must not change between the two reads.
    ``order`` must be unique for the numbering to be deterministic.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    sorted_rows = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = cut_lineage(sorted_rows.withColumn("_slot", F.monotonically_increasing_id()), "ordinal")
    # The id holds the partition number above the row's position in it.
    placed = placed.withColumn("_part", F.shiftright("_slot", _POSITION_BITS)).withColumn(
        "_pos", F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1)
    )
    # One row per partition of the sort: bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + F.lit(start))
        .drop("_part", "_pos", "_slot", "_offset")
    )
