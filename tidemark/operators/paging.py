"""Ordering, paging and numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scale import with_ordinal


def keyset_page(df: DataFrame, id_col: str, last: int, size: int) -> DataFrame:
    """The page of ids after ``last``; the range reaches the scan."""
    return df.filter((F.col(id_col) > last) & (F.col(id_col) <= last + size))


def page_of(id_col: str | Column, size: int) -> Column:
    """Number of the page that an id falls on, from 0."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.floor((column - 1) / F.lit(size)).cast("long")


def sorted_by(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.orderBy(*cols)


def exists(df: DataFrame, predicate: Column) -> bool:
    return not df.filter(predicate).limit(1).isEmpty()


def cluster_within(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Storage order inside each output file."""
    return df.sortWithinPartitions(*cols)


def renumber(df: DataFrame, order: Sequence[str | Column], name: str = "ordinal", start: int = 1) -> DataFrame:
    """Running number over all rows in a unique order."""
    return with_ordinal(df, list(order), name, start)
