"""Writers that can be run again without changing the result."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import first_per_key
from tidemark.scale import delete_path, matching_paths, rename_path, write_text


def append_partition(
    df: DataFrame,
    path: str,
    ts_col: str,
    day_col: str = "day",
    order: Sequence[str] = (),
    days: Sequence[str | dt.date] = (),
    part: tuple[str, str] | None = None,
) -> None:
    """Write the days in ``df`` in place of what the table held for them.

    ``days`` are replaced even where ``df`` has no rows of theirs. With
    ``part``, a column and a value, each day is partitioned by it once more
    and only folders of that value are replaced, in all days. Rows are brought
    together by day; days larger than the advisory partition size are split
    over several writers, small ones share one.
    """
    spark = df.sparkSession
    rows = df.withColumn(day_col, F.to_date(ts_col))
    columns = [day_col]
    if part:
        rows, columns = rows.withColumn(part[0], F.lit(part[1])), [day_col, part[0]]
    below = f"/{part[0]}={part[1]}" if part else ""
    patterns = [f"{path}/{day_col}=*{below}"] if part else [f"{path}/{day_col}={d}" for d in days]
    held = [p for pattern in patterns for p in matching_paths(spark, pattern)]
    rows = rows.hint("rebalance", F.col(day_col))
    if order:
        rows = rows.sortWithinPartitions(day_col, *order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    if held:
        # One row per day of this load.
        written = {f"{day_col}={r[0] or '__HIVE_DEFAULT_PARTITION__'}{below}" for r in df.select(F.to_date(ts_col)).distinct().collect()}
        for old in held:
            if not any(old.endswith(f"/{name}") for name in written):
                delete_path(spark, old)


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """New rows to append: one per key, and none whose key the target holds."""
    fresh = new.join(target.select(*keys), list(keys), "left_anti")
    return first_per_key(fresh, list(keys), order).select(*new.columns)


def upsert_state(state: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Latest state per key, where a change of equal version replaces the old row."""
    rest = [c for c in state.columns if c != key]
    both = state.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return (
        both.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(version, "_new")).alias("_row"))
        .select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in state.columns])
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a table that ``df`` may itself read from.

    The new version is complete beside the table before the old one goes, and
    takes its place by a rename. Should the process end between the two,
    ``read_or_empty`` finds the new version under its own name.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new"
    delete_path(spark, fresh)
    df.write.parquet(fresh)
    delete_path(spark, path)
    rename_path(spark, fresh, path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table's rows, or none if it was never written."""
    for place in (path, f"{path.rstrip('/')}.new"):
        if matching_paths(spark, f"{place}/_SUCCESS") or (place == path and matching_paths(spark, f"{place}/*")):
            return spark.read.schema(schema).parquet(place)
    return spark.createDataFrame([], schema)


def _bucketed_name(path: str) -> str:
    return "tidemark_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _buckets(spark: SparkSession, path: str) -> int | None:
    """Number of buckets as noted beside a table's files, in a name that readers skip."""
    found = matching_paths(spark, f"{path.rstrip('/')}/_buckets-*")
    return int(found[0].rsplit("-", 1)[1]) if found else None


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """A table whose files are bucketed by its keys; empty if it was never written.

    Joined on the keys it is not shuffled, so a load of new rows moves the new
    rows only. The number of buckets is settled when the table is first used
    (by default the number of shuffle partitions) and kept beside its files;
    sessions find the table by its path.
    """
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        settled = _buckets(spark, path)
        if settled is None:
            settled = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            write_text(spark, f"{path.rstrip('/')}/_buckets-{settled}", "")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {settled} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def append_bucketed(df: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Add rows to a bucketed table, one file per bucket, and read it."""
    spark = df.sparkSession
    read_bucketed(spark, path, schema, keys, buckets)
    df.select(*schema.names).repartition(_buckets(spark, path), *keys).write.insertInto(_bucketed_name(path))
    return spark.table(_bucketed_name(path))


def export_frame(df: DataFrame, cat_col: str) -> DataFrame:
    """Everything as text with blanks for missing values."""
    return df.select(
        F.col(f"`{cat_col}`"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns if c != cat_col],
    )


def _csv_cell(value: Column) -> Column:
    """A text as a CSV cell, quoted where it must be."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.rlike('[",\\r\\n]'), quoted).otherwise(value)


def export_lines(df: DataFrame, cat_col: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """(category, file, line) of one CSV file or more per category, each with a header first.

    A category's files only have the columns that hold any text in it. Which
    these are, and how many files it needs, one aggregate finds for all
    categories; rows and headers then go out together, sorted so that each
    file's header is its first line. Rows lie in the files by their hash.
    """
    category = F.col(f"`{cat_col}`")
    frame = export_frame(df, cat_col)
    names = [cat_col, *(c for c in frame.columns if c != cat_col)]
    held = [F.bool_or(F.col(f"`{c}`") != "").alias(f"_{i}") for i, c in enumerate(names[1:], 1)]
    report = frame.groupBy(category.alias("_of")).agg(F.ceil(F.count("*") / rows_per_file).alias("_files"), *held)
    # The category itself always stays.
    kept = F.array(F.lit(True), *[F.coalesce(F.col(f"_{i}"), F.lit(False)) for i in range(1, len(names))])
    report = report.select("_of", "_files", kept.alias("_kept"))

    def line(cells: list[Column]) -> Column:
        wanted = F.filter(F.arrays_zip(F.array(*cells).alias("cell"), F.col("_kept").alias("kept")), lambda c: c["kept"])
        return F.array_join(F.transform(wanted, lambda c: c["cell"]), ",")

    cells = [_csv_cell(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in names]
    rows = frame.join(report, category.eqNullSafe(F.col("_of")))
    rows = rows.select(category.alias("_category"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), "_files").alias("_file"), F.lit(1).alias("_body"), line(cells).alias("line"))
    headers = report.select(
        F.col("_of").alias("_category"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_files") - 1)).alias("_file"),
        F.lit(0).alias("_body"), line([_csv_cell(F.lit(c)) for c in names]).alias("line"),
    )
    return rows.unionByName(headers)


def export_by_category(df: DataFrame, cat_col: str, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV files per category without the columns that are empty in it, all by one write."""
    lines = export_lines(df, cat_col, rows_per_file).repartition("_category", "_file")
    lines = lines.sortWithinPartitions("_category", "_file", "_body", "line").select("_category", "_file", "line")
    lines.write.mode("overwrite").partitionBy("_category", "_file").text(path)


def write_by_kind(df: DataFrame, path: str, kind: str = "kind") -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(kind).parquet(path)


def write_jdbc(df: DataFrame, options: Mapping[str, str], batch_size: int = 10_000, mode: str = "append") -> None:
    """All rows over JDBC in batches; the partitions write side by side."""
    df.write.format("jdbc").options(**options).option("batchsize", batch_size).mode(mode).save()
