"""Unions of differently shaped or tagged inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_padded(*frames: DataFrame) -> DataFrame:
    """Union by name; columns an input lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(frames: Mapping[str, DataFrame], tag_col: str = "layer") -> DataFrame:
    return union_padded(*[df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()])


def union_renamed(frames: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Project each input to the same target names, then append."""
    return union_padded(
        *[df.select(*[F.col(f"`{s}`").alias(t) for s, t in names.items()]) for df, names in frames]
    )


def union_roles(df: DataFrame, cols: Sequence[str], as_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value found in any of the role columns."""
    # One pass: the roles become elements of an array instead of a second scan.
    return df.select(*keep, F.explode(F.array(*cols)).alias(as_col)).filter(F.col(as_col).isNotNull()).distinct()
