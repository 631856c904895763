"""Listings of files and the small files themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import iso_date_in
from tidemark.functions.text import file_name
from tidemark.schemas import texts


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, name, modified, length)`` of the files below a folder; contents are not read.

    Empty files and hidden ones (such as markers starting with a dot) do not appear.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    )
    return files.select(
        "path", file_name("path").alias("name"), F.col("modificationTime").alias("modified"), "length"
    )


def folder_below(path: str | Column, root: str) -> Column:
    """First folder of a path below ``root``, NULL for files directly in it."""
    column = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(column, rf"\Q{root.rstrip('/')}\E/([^/]+)/", 1), F.lit(""))


def extension_rank(name: str | Column, extensions: Sequence[str]) -> Column:
    """Position of a name's extension in the list, NULL if not in it."""
    column = F.lower(F.col(name) if isinstance(name, str) else name)
    rank = None
    for i, extension in enumerate(extensions):
        hit = column.endswith(extension)
        rank = F.when(hit, i) if rank is None else rank.when(hit, i)
    return rank


def first_by_extension(listing: DataFrame, folder: str, extensions: Sequence[str]) -> DataFrame:
    """One file per folder: best extension first, then the smallest path."""
    ranked = listing.withColumn("_rank", extension_rank("path", extensions)).filter(F.col("_rank").isNotNull())
    return ranked.groupBy(folder).agg(F.min_by("path", F.struct("_rank", "path")).alias("path"))


def read_binary_files(spark: SparkSession, root: str, extensions: Sequence[str] = (".pdf", ".png")) -> DataFrame:
    """``(folder, path, content)``: the attached document of each folder below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listing = files.select("path", folder_below("path", root).alias("folder")).filter("folder is not null")
    chosen = first_by_extension(listing, "folder", extensions)
    return files.select("path", "content").join(chosen, "path").select("folder", "path", "content")


def read_line_list(spark: SparkSession, path: str) -> DataFrame:
    """One term per non-empty line."""
    return spark.read.text(path).select(F.rtrim("value").alias("term")).filter("term <> ''")


def read_lines(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, line_no, line)`` of text files, numbered from 1 in each file."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    lines = files.select(
        F.col("_metadata.file_path").alias("path"),
        F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("_pos", "line"),
    )
    return lines.select("path", (F.col("_pos") + 1).alias("line_no"), "line")


def new_files_only(listing: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    """Files whose key is not in the ledger of those processed."""
    return listing.join(ledger.select(key), key, "left_anti")


def unmarked_folders(listing: DataFrame, folder: str = "folder", marker: str = ".success") -> DataFrame:
    """Folders that hold no marker file yet, by a listing that shows markers."""
    marks = listing.groupBy(folder).agg(F.bool_or(F.col("name") == marker).alias("_marked"))
    return marks.filter(~F.coalesce("_marked", F.lit(False))).select(folder)


def temp_file_filter(listing: DataFrame, col: str = "name") -> DataFrame:
    """Leave out lock files of editors."""
    return listing.filter(~F.contains(F.col(col), F.lit("~")))


def request_header(listing: DataFrame, run_date: Column, type_id: int = 0, folder: str = "folder") -> DataFrame:
    """One header row per folder, dated by the folder's name or else by the run."""
    return (
        listing.groupBy(folder)
        .agg(F.count("*").alias("files"))
        .select(
            iso_date_in(folder, run_date).alias("request_date"),
            F.lit(type_id).alias("request_type_id"),
            F.col(folder).alias("request_name"),
            "files",
        )
    )


def folder_headers(
    listing: DataFrame,
    root: str,
    run_date: Column,
    type_id: int = 0,
    reg_num: str | None = None,
    extensions: Sequence[str] = (".pdf", ".png"),
    scans: bool = True,
    dated: bool = True,
) -> DataFrame:
    """One header row per folder below ``root``: date, number, type, name, path, scan and number of files.

    The date is the one in the folder's name (only where ``dated``) or else
    the run's. The scan is the folder's first file by extension, blank where
    it has none or scans are not wanted. A folder whose files are all hidden
    still has a header.
    """
    files = listing.withColumn("folder", folder_below("path", root)).where("folder IS NOT NULL")
    rank = F.when(F.lit(scans), extension_rank("path", extensions))
    first = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), "path")))
    found = files.groupBy("folder").agg(first["path"].alias("scan"), F.count_if(~F.col("name").startswith(".")).alias("files"))
    return found.select(
        (iso_date_in("folder", run_date) if dated else run_date).alias("request_date"),
        F.lit(reg_num).cast("string").alias("request_reg_num"),
        F.lit(type_id).alias("request_type_id"),
        F.col("folder").alias("request_name"),
        F.concat(F.lit(f"{root.rstrip('/')}/"), "folder").alias("request_description"),
        F.coalesce("scan", F.lit("")).alias("request_pdf"),
        "files",
    )


def load_classifier(spark: SparkSession, path: str, fmt: str = "csv", **options: str) -> DataFrame:
    """Code/value pairs, codes trimmed and unique."""
    schema = texts("code", "value")
    rows = spark.read.format(fmt).schema(schema).options(**{"header": "true", **options}).load(path)
    return rows.groupBy(F.trim("code").alias("code")).agg(F.min("value").alias("value"))
