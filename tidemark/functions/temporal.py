"""Dates, times and zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import UNICODE, _col, extract_or_null

# Genitive month names, with both spellings in use for May.
MONTHS = {
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "майя": 5, "июня": 6, "июля": 7,
    "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
}


def to_day(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


def run_ts(value: str | dt.datetime) -> Column:
    """The run's own timestamp as a column."""
    return F.lit(str(value)).cast("timestamp")


def local_to_utc(text: str | Column, zone: str = "US/Eastern", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Wall-clock text of a zone to UTC; NULL if the text is no time."""
    return F.to_utc_timestamp(F.try_to_timestamp(_col(text), F.lit(fmt)), zone)


def year_of(date: str | Column) -> Column:
    return F.year(_col(date))


def parse_date(text: str | Column, fmt: str) -> Column:
    """Date in the given form, NULL for impossible ones."""
    return F.to_date(F.try_to_timestamp(_col(text), F.lit(fmt)))


def date_from_name(name: str | Column, year_from: str | Column) -> Column:
    """Date of the first ``dd.mm`` in a name, in the year of another column."""
    token = extract_or_null(name, r"\d\d\.\d\d")
    return parse_date(F.concat(F.date_format(_col(year_from), "yyyy"), F.lit("."), token), "yyyy.dd.MM")


def iso_date_in(text: str | Column, default: Column) -> Column:
    """First ``yyyy-MM-dd`` in a text, else the default."""
    found = parse_date(extract_or_null(text, r"\d\d\d\d-\d\d-\d\d"), "yyyy-MM-dd")
    return F.coalesce(found, default)


def form_date(options: str | Column) -> Column:
    """Form date kept in a JSON text of document options."""
    return extract_or_null(options, r'@DateForm":\s*"(.*?)"', 1).try_cast("date")


def dated_name(day: str | Column, name: str | Column, fmt: str = "yyyyMMdd", sep: str = "_") -> Column:
    return F.concat(F.date_format(_col(day), fmt), F.lit(sep), _col(name))


def relative_ts(text: str | Column, now: Column) -> Column:
    """Time of "today at", "yesterday at" and "day month at" texts.

    A day and month later in the year than ``now`` belong to the year before.
    Anything else gives NULL.
    """
    text = _col(text)
    today = F.to_date(now)
    clock = r"в\s+(\d{1,2}:\d{2})"

    def at(day: Column, time_text: Column) -> Column:
        return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), time_text).try_cast("timestamp")

    parts = rf"{UNICODE}(\d+)\s+(\w+)\s+{clock}"
    months = F.create_map(*[x for word, number in MONTHS.items() for x in (F.lit(word), F.lit(number))])
    month = F.try_element_at(months, F.regexp_extract(text, parts, 2))
    day_number = extract_or_null(text, parts, 1).try_cast("int")

    def on(year: Column) -> Column:
        return F.format_string("%04d-%02d-%02d", year, month, day_number).try_cast("date")

    this_year = on(F.year(today))
    dated = F.when(this_year.isNull() | (this_year > today), on(F.year(today) - 1)).otherwise(this_year)
    return (
        F.when(F.contains(text, F.lit("сегодня")), at(today, extract_or_null(text, "сегодня " + clock, 1)))
        .when(F.contains(text, F.lit("вчера")), at(F.date_sub(today, 1), extract_or_null(text, "вчера " + clock, 1)))
        .when(month.isNotNull(), at(dated, extract_or_null(text, parts, 3)))
    )
