"""Listings that also show empty and hidden files, which Spark's own file sources leave out."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Functions that run inside tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROWS = 4096


class _Folders(InputPartition):
    """Folders whose files one task lists, and whether with all below them."""

    def __init__(self, paths: list[str], deep: bool):
        self.paths, self.deep = paths, deep


class _ListingReader(DataSourceReader):
    def __init__(self, root: str, tasks: int):
        self._root, self._tasks = root, tasks

    def partitions(self) -> list[InputPartition]:
        """The folder itself, and its folders dealt to tasks; only their names are known to the driver."""
        system, path = fs.FileSystem.from_uri(self._root)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        folders = sorted(f.path for f in found if f.type == fs.FileType.Directory)
        tasks = max(1, min(self._tasks, len(folders)))
        return [_Folders([path], False), *(_Folders(folders[k::tasks], True) for k in range(tasks) if folders[k::tasks])]

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(self._root)
        rows: list[tuple] = []
        for path in partition.paths:
            for f in system.get_file_info(fs.FileSelector(path, recursive=partition.deep, allow_not_found=True)):
                if f.type != fs.FileType.File:
                    continue
                below = f.path[len(root.rstrip("/")) + 1 :]
                rows.append((f"{self._root}/{below}", f.base_name, f.mtime, f.size))
                if len(rows) == _ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    paths, names, times, sizes = zip(*rows, strict=True)
    times = pa.array(times, pa.timestamp("us", "UTC"))
    return pa.RecordBatch.from_arrays([pa.array(paths), pa.array(names), times, pa.array(sizes, pa.int64())], ["path", "name", "modified", "length"])


class FileListing(DataSource):
    """Files below a folder, listed by tasks folder by folder."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, name string, modified timestamp, length long"

    def reader(self, schema) -> DataSourceReader:
        return _ListingReader(self.options["path"].rstrip("/"), int(self.options.get("tasks", 64)))


def list_all_files(spark: SparkSession, path: str, tasks: int = 64) -> DataFrame:
    """``(path, name, modified, length)`` of all files below a folder, also empty and hidden ones.

    The folders directly below it are shared out to ``tasks`` tasks; contents
    are not read. The file system must be one that pyarrow knows.
    """
    spark.dataSource.register(FileListing)
    return spark.read.format("file_listing").option("tasks", tasks).load(path)


def mark_folders(folders: DataFrame, root: str, folder: str = "folder", marker: str = ".success") -> None:
    """Put an empty marker into each of the given folders below ``root``; the tasks write them."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(root)
        done = 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system.create_dir(f"{path}/{name}", recursive=True)
                with system.open_output_stream(f"{path}/{name}/{marker}"):
                    done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["n"])

    names = folders.select(F.col(folder).cast("string")).where(F.col(folder).isNotNull())
    names.mapInArrow(mark, "n long").agg(F.sum("n")).collect()
