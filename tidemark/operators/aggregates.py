"""Grouped aggregations, including those usually written as window functions.

First, last and extreme rows are taken with ``min_by``/``max_by``, which
combine on the map side, so a hot group never has to be sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import _col


def totals(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cols])


def row_counts(df: DataFrame, by: Sequence[str], out: str = "count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(out))


def distinct_count(
    df: DataFrame, by: Sequence[str], col: str, out: str = "count", approx: bool = False
) -> DataFrame:
    count = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.groupBy(*by).agg(count.alias(out))


def extremes(df: DataFrame, by: Sequence[str], low: str, high: str | None = None) -> DataFrame:
    """Smallest ``low`` and largest ``high`` per group."""
    return df.groupBy(*by).agg(F.min(low).alias(f"min_{low}"), F.max(high or low).alias(f"max_{high or low}"))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order, which must break all ties."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*[_col(o) for o in order])).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient as a double; NULL when the divisor is zero."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def pct_change(start: str | Column, end: str | Column) -> Column:
    """Change in percent of the start value; NULL when that is zero."""
    return (_col(end) - _col(start)) / F.nullif(_col(start), F.lit(0)) * 100


def non_null_count(df: DataFrame, by: Sequence[str], col: str | Column, out: str = "count") -> DataFrame:
    return df.groupBy(*by).agg(F.count(_col(col)).alias(out))


def category_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def non_empty_columns(df: DataFrame, by: str) -> DataFrame:
    """Per category, whether each other column holds any text at all."""
    rest = [c for c in df.columns if c != by]
    flags = [
        F.coalesce(F.bool_or(F.col(f"`{c}`").cast("string") != ""), F.lit(False)).alias(c) for c in rest
    ]
    return df.groupBy(by).agg(*flags)


def window_count(df: DataFrame, by: Sequence[str], col: str, out: str = "count", per_row: bool = False) -> DataFrame:
    """Count per group, one row per group or attached to every row."""
    counts = df.groupBy(*by).agg(F.count(col).alias(out))
    return df.join(counts, list(by), "left") if per_row else counts


def latest_value(df: DataFrame, value: str, order: str | Column, by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Value of the row that comes last in the order, overall or per group."""
    return df.groupBy(*by).agg(F.max_by(value, _col(order)).alias(out or value))


def first_in_group(df: DataFrame, by: Sequence[str], value: str, order: str | Column, out: str = "first") -> DataFrame:
    return df.groupBy(*by).agg(F.min_by(value, _col(order)).alias(out))


def last_in_group(df: DataFrame, by: Sequence[str], value: str, order: str | Column, out: str = "last") -> DataFrame:
    return df.groupBy(*by).agg(F.max_by(value, _col(order)).alias(out))


def arg_max(df: DataFrame, by: Sequence[str], value: str, measure: str | Column, out: str = "arg_max") -> DataFrame:
    """Smallest ``value`` among the rows with the largest measure."""
    by_value = df.groupBy(*by, value).agg(F.max(_col(measure)).alias("_measure")).filter("_measure IS NOT NULL")
    top = by_value.groupBy(*by).agg(F.max("_measure").alias("_top"))
    best = by_value.join(top, list(by)).filter("_measure = _top")
    return best.groupBy(*by).agg(F.min(value).alias(out))


def earliest_at_max(ts: str, measure: str | Column) -> Column:
    """Earliest time with the largest measure, as one aggregate.

    ``measure`` is a whole number. The two are packed into one decimal, which
    keeps the hash aggregate where a struct would force a sort.
    """
    when = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    scaled = _col(measure).cast("decimal(19,0)") * F.lit(Decimal(10**18))
    return F.max_by(F.col(ts), scaled - when)


def earliest_at_min(ts: str, measure: str | Column) -> Column:
    when = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    scaled = _col(measure).cast("decimal(19,0)") * F.lit(Decimal(10**18))
    return F.min_by(F.col(ts), scaled + when)


def pivot_rows(df: DataFrame, by: Sequence[str], key: str, value: str, codes: Mapping[str, str]) -> DataFrame:
    """Key/value rows to one column per code."""
    return df.groupBy(*by).agg(
        *[F.min(F.when(F.col(key) == code, F.col(value))).alias(name) for code, name in codes.items()]
    )
