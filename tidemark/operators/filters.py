"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import _col, contains_any

# Markers of pages that are no listings.
BLOCKED_URL_MARKERS = ["blocked", "search"]
BLOCKED_PHRASES = ["произошла ошибка", '"error":', "Доступ ограничен"]
EMPTY_RESULT_PHRASES = [
    "Объявления по вашему запросу в других городах",
    "Похоже на то, что вы ищете",
    "Ничего не найдено в выбранной области поиска",
]
MISSING_PAGE_PHRASES = ["Такой страницы нe существует"]


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, in the mapping's order."""
    return df.select(*[F.col(f"`{src}`").alias(alias) for src, alias in names.items()])


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(cols))


def day_slice(df: DataFrame, ts_col: str, day: dt.date | str, days: int = 1) -> DataFrame:
    """Rows of a day (or some days from it), as a range that reaches the scan."""
    start = dt.date.fromisoformat(day) if isinstance(day, str) else day
    low = F.lit(dt.datetime.combine(start, dt.time()).isoformat(sep=" ")).cast("timestamp_ntz")
    end = start + dt.timedelta(days=days)
    high = F.lit(dt.datetime.combine(end, dt.time()).isoformat(sep=" ")).cast("timestamp_ntz")
    kind = df.schema[ts_col].dataType.typeName()
    if kind == "date":
        low, high = F.lit(start), F.lit(end)
    elif kind == "timestamp":
        low, high = low.cast("timestamp"), high.cast("timestamp")
    return df.filter((F.col(ts_col) >= low) & (F.col(ts_col) < high))


def only_done(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) == "done")


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def is_not_true(col: str | Column) -> Column:
    """True for false and for NULL."""
    return ~F.coalesce(_col(col), F.lit(False))


def by_extension(df: DataFrame, col: str, extension: str) -> DataFrame:
    return df.filter(F.contains(F.col(col), F.lit("." + extension.lstrip("."))))


def strict_payload(payload: str | Column, fields: Sequence[str]) -> Column:
    """Whether a map's key set is exactly the given fields."""
    return F.array_sort(F.map_keys(_col(payload))) == F.array(*[F.lit(f) for f in sorted(fields)])


def blocked(
    url: str | Column,
    html: str | Column,
    url_markers: Sequence[str] = BLOCKED_URL_MARKERS,
    phrases: Sequence[str] = BLOCKED_PHRASES,
) -> Column:
    """Whether a page is an error or block page instead of content."""
    return F.coalesce(
        _col(html).isNull() | contains_any(url, url_markers) | contains_any(html, phrases), F.lit(True)
    )


def not_blocked(
    pages: DataFrame,
    url_markers: Sequence[str] = BLOCKED_URL_MARKERS,
    phrases: Sequence[str] = BLOCKED_PHRASES,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    return pages.filter(~blocked(url, html, url_markers, phrases))


def has_phrase(col: str | Column, phrases: Sequence[str]) -> Column:
    return contains_any(col, phrases)


def exclude_category(
    df: DataFrame, col: str, words: Sequence[str] = ("снять", "новостро")
) -> DataFrame:
    """Drop rows whose lower-cased category holds one of the words."""
    return df.filter(~contains_any(F.lower(col), words))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def date_between(df: DataFrame, col: str, low: dt.date | str, high: dt.date | str) -> DataFrame:
    """Both bounds belong to the range."""
    return df.filter(F.col(col).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def after_mark(df: DataFrame, id_col: str, mark: int) -> DataFrame:
    return df.filter(F.col(id_col) > F.lit(mark))


def by_id(df: DataFrame, id_col: str, ids: DataFrame | Sequence) -> DataFrame:
    """Rows of the given ids, listed or in another DataFrame."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(id_col), id_col, "left_semi")
    return df.filter(F.col(id_col).isin(list(ids)))


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Only the columns the target shares, in its order and types."""
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target if f.name in df.columns]
    )
