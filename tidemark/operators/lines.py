"""Rewrites of text records kept as (file, line number, line)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scale import with_ordinal


def replace_marked(line: Column, marker: str, text: str) -> Column:
    """Lines that hold the marker become another text."""
    return F.when(F.contains(line, F.lit(marker)), F.lit(text)).otherwise(line)


def drop_lead(line: Column, marker: str) -> Column:
    """Lines that hold the marker lose their first character."""
    return F.when(F.contains(line, F.lit(marker)), F.substr(line, F.lit(2))).otherwise(line)


def map_delimiter(line: Column) -> Column:
    """The delimiter line of a map file names the comma."""
    return replace_marked(line, "Delimiter", 'Delimiter ","')


def map_coordinates(line: Column) -> Column:
    """The coordinate-system line of a map file starts without a blank."""
    return drop_lead(line, " CoordSys")


def renumber_leading(df: DataFrame, order: Sequence[str], line: str = "line", start: int = 1) -> DataFrame:
    """The number a line starts with becomes its position over all files."""
    numbered = with_ordinal(df, list(order), "_no", start)
    text = F.regexp_replace(F.col(line), F.lit(r"^(\d+)"), F.col("_no").cast("string"))
    return numbered.withColumn(line, text).drop("_no")
