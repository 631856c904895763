"""Joins and set-membership operators.

No side is forced to be broadcast: Spark broadcasts one whose size it has
measured to be small, and otherwise shuffles with hot keys split at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scale import cut_lineage


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, _names(on), "inner")


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, _names(on), "left")


def join_role(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join one dimension several times, once per role.

    ``roles`` maps a column of ``df`` to the prefix for the dimension columns
    that its match brings in.
    """
    for col, prefix in roles.items():
        role = dim.select(
            F.col(key).alias(f"_{prefix}key"),
            *[F.col(c).alias(prefix + c) for c in dim.columns if c != key],
        )
        df = df.join(role, F.col(col) == F.col(f"_{prefix}key"), how).drop(f"_{prefix}key")
    return df


def only_new(
    new: DataFrame, old: DataFrame, keys: str | Sequence[str], old_filter: Column | None = None
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old`` (or in its filtered part)."""
    if old_filter is not None:
        old = old.filter(old_filter)
    keys = _names(keys)
    return new.join(old.select(*keys), keys, "left_anti")


def matching(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``."""
    keys = _names(keys)
    return left.join(right.select(*keys), keys, "left_semi")


def exclude(df: DataFrame, blacklist: DataFrame, key: str, list_key: str | None = None) -> DataFrame:
    """Drop every record named on a list."""
    names = blacklist.select(F.col(list_key or key).alias(key))
    return df.join(names, key, "left_anti")


def prune_empty(levels: Sequence[tuple[DataFrame, str | None]], leaves: DataFrame, key: str) -> list[DataFrame]:
    """Drop containers without a surviving child, from the lowest level up.

    ``levels`` goes from the lowest container level to the top; each entry is
    the level's rows (with column ``key``) and the name of its parent column
    (``None`` for the top). ``leaves`` carries ``parent`` values of the lowest
    level.
    """
    survivors = leaves.select(F.col("parent").alias(key))
    kept = []
    for rows, parent in levels:
        alive = rows.join(survivors, key, "left_semi")
        kept.append(alive)
        if parent is not None:
            survivors = alive.select(F.col(parent).alias(key))
    return kept


def matching_files(
    files: DataFrame, listing: DataFrame, key: Column, listing_key: Column, keep: bool = True
) -> DataFrame:
    """Files whose derived name is (or, with ``keep=False``, is not) in a listing."""
    names = listing.select(listing_key.alias("_name"))
    marked = files.withColumn("_name", key)
    return marked.join(names, "_name", "left_semi" if keep else "left_anti").drop("_name")


def join_on_derived_date(
    left: DataFrame, right: DataFrame, left_date: Column, right_date: str, how: str = "left"
) -> DataFrame:
    """Join rows whose computed date equals a date of the other side."""
    return left.withColumn("_date", left_date).join(
        right.withColumnRenamed(right_date, "_date"), "_date", how
    ).withColumnRenamed("_date", right_date)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Attach the latest row of ``right`` at or before the time of each left row.

    Both sides go together through ranges of (key, time), so each is read
    once and a key with most of the rows lies in many ranges, as do the rows
    of one key and time. A range only knows the values within it; the last
    value of the ranges before is carried in, one row per range and key. The
    ranges are written to the shared folder first, as their ends must not
    change between the two reads. Of right rows with equal key and time the
    one with the largest values counts. Left rows without key or time match
    nothing.
    """
    by = _names(by)
    carried = F.struct(*[F.col(v) for v in values])
    known = right.where(F.col(right_ts).isNotNull()).select(*by, F.col(right_ts).alias("_ts"), carried.alias("_value"))
    rest = [c for c in left.columns if c not in by]
    asked = left.select(*by, F.col(left_ts).alias("_ts"), F.struct(*rest).alias("_row"), F.xxhash64(*left.columns).alias("_mix"))
    points = known.unionByName(asked, allowMissingColumns=True).withColumn("_asks", F.col("_row").isNotNull())
    order = [*by, "_ts", "_asks", "_value", "_mix"]
    ranges = points.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranges.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "asof")

    within = Window.partitionBy("_part", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_value", F.last("_value", ignorenulls=True).over(within)).where("_asks")
    # One row per range and key that has values there.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("_part", *by).agg(F.max(F.when(~F.col("_asks"), F.col("_at"))).alias("_at"), F.max("_asks").alias("_asks"))
    last = ends.join(placed.select("_at", "_value"), "_at", "left").withColumn("_carried", F.last("_value", ignorenulls=True).over(before))
    carry = last.where(F.col("_asks") & F.col("_carried").isNotNull()).select("_part", *[F.col(c).alias(f"_{c}") for c in by], "_carried")
    joined = local.join(carry.withColumnRenamed("_part", "_of"), (local["_part"] == F.col("_of")) & _same(local, by), "left")
    found = joined.withColumn("_value", F.coalesce("_value", "_carried"))
    if how == "inner":
        found = found.where(F.col("_value").isNotNull())
    return found.select(
        *[c if c in by else F.col("_row")[c].alias(c) for c in left.columns], *[F.col("_value")[v].alias(v) for v in values]
    )


def _same(rows: DataFrame, by: Sequence[str]) -> Column:
    """Equal keys of the rows and of columns named with an underscore before."""
    return reduce(lambda a, b: a & b, [rows[c] == F.col(f"_{c}") for c in by])
