"""Star schema of prices: ledger, dimensions, fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.filters import is_not_true
from tidemark.operators.joins import only_new
from tidemark.scale import with_ordinal


def pending_uploads(ledger: DataFrame) -> DataFrame:
    """Ledger rows not marked as uploaded, whether false or not set."""
    return ledger.filter(is_not_true("uploaded"))


def mark_uploaded(ledger: DataFrame, day: dt.date | str | Column, date: str = "date") -> DataFrame:
    """Mark every load of a day as done."""
    value = day if isinstance(day, Column) else F.lit(day).cast("date")
    return ledger.withColumn("uploaded", F.when(F.to_date(date) == value, F.lit(True)).otherwise(F.col("uploaded")))


def mark_loaded(ledger: DataFrame, loaded: DataFrame) -> DataFrame:
    """Mark the loads of the given ``(symbol_name, interval_name, date)`` as done."""
    keys = ["symbol_name", "interval_name", "date"]
    flags = loaded.select(*keys).distinct().withColumn("_done", F.lit(True))
    return (
        ledger.join(flags, keys, "left")
        .withColumn("uploaded", F.coalesce("_done", "uploaded"))
        .select(*ledger.columns)
    )


def open_uploads(ledger: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ledger rows to add for ``(symbol_name, interval_name, date)`` not yet in the ledger."""
    keys = ["symbol_name", "interval_name", "date"]
    fresh = only_new(wanted.select(*keys).distinct(), ledger, keys)
    top = ledger.agg(F.coalesce(F.max("upload_id"), F.lit(0))).first()[0]
    numbered = with_ordinal(fresh, keys, "upload_id", top + 1)
    return numbered.withColumn("uploaded", F.lit(None).cast("boolean")).select(*ledger.columns)


def stamp_uploads(bars: DataFrame, opened: DataFrame, symbol: str = "symbol", time: str = "time") -> DataFrame:
    """Give each bar the id of the load it belongs to; bars of refused loads are left out."""
    loads = opened.select(
        F.col("symbol_name").alias(symbol), F.to_date("date").alias("_day"), "upload_id"
    )
    return bars.withColumn("_day", F.to_date(time)).join(loads, [symbol, "_day"]).drop("_day")


def load_dimension(target: DataFrame, values: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Unseen natural keys with the next ids, in the order of the keys."""
    fresh = only_new(values.select(*keys).dropna("any").distinct(), target, list(keys))
    top = target.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    return with_ordinal(fresh, list(keys), id_col, top + 1).select(id_col, *keys)


def time_serial_values(stocks: DataFrame, ledger: DataFrame, intervals: DataFrame) -> DataFrame:
    """Bar times of the pending loads with their interval's id."""
    loads = pending_uploads(ledger).select("upload_id", "interval_name")
    return (
        stocks.join(loads, "upload_id")
        .join(intervals, "interval_name")
        .select(F.col("time").alias("time_serial_time"), F.col("interval_id").alias("time_serial_interval_id"))
        .distinct()
    )


def open_symbol_history(hist: DataFrame, act: DataFrame, ledger: DataFrame) -> DataFrame:
    """First history rows of symbols without an open one, valid from their first load."""
    loads = pending_uploads(ledger).groupBy("symbol_name").agg(F.min("date").alias("symbol_valid_from"))
    fresh = only_new(loads.join(act, "symbol_name"), hist, "symbol_name", F.col("symbol_valid_to").isNull())
    return fresh.withColumn("symbol_valid_to", F.lit(None).cast(hist.schema["symbol_valid_to"].dataType)).select(
        *hist.columns
    )


def load_fact_price(
    fact: DataFrame | None,
    stocks: DataFrame,
    ledger: DataFrame,
    intervals: DataFrame,
    symbols: DataFrame,
    times: DataFrame,
) -> DataFrame:
    """Bars of pending loads as fact rows not yet there, one per symbol and time.

    A time belongs to its interval. Should a bar come in several pending loads,
    the one of the lowest upload id counts.
    """
    loads = pending_uploads(ledger).select("upload_id", "symbol_name", "interval_name")
    bars = (
        stocks.join(loads, "upload_id")
        .join(intervals, "interval_name")
        .join(symbols.select("symbol_id", "symbol_name"), "symbol_name")
        .withColumnsRenamed({"time": "time_serial_time", "interval_id": "time_serial_interval_id"})
        .join(times, ["time_serial_time", "time_serial_interval_id"])
    )
    rows = bars.select(
        "upload_id",
        F.col("open").alias("price_open"),
        F.col("high").alias("price_high"),
        F.col("low").alias("price_low"),
        F.col("close").alias("price_close"),
        F.col("volume").alias("price_volume"),
        F.col("symbol_id").alias("price_symbol_id"),
        F.col("time_serial_id").alias("price_time_id"),
    )
    keys = ["price_symbol_id", "price_time_id"]
    if fact is not None:
        rows = only_new(rows, fact, keys)
    measures = ["price_open", "price_high", "price_low", "price_close", "price_volume"]
    return (
        rows.groupBy(*keys)
        .agg(F.min(F.struct("upload_id", *measures)).alias("_bar"))
        .select(*[F.col("_bar")[m].alias(m) for m in measures], *keys)
    )


def fact_bars(fact: DataFrame, symbols: DataFrame, times: DataFrame) -> DataFrame:
    """Fact rows with symbol name and time, in the shape of bars; missing dimensions stay NULL."""
    named = fact.join(
        symbols.select(F.col("symbol_id").alias("price_symbol_id"), F.col("symbol_name").alias("symbol")),
        "price_symbol_id",
        "left",
    )
    timed = named.join(
        times.select(F.col("time_serial_id").alias("price_time_id"), F.col("time_serial_time").alias("time")),
        "price_time_id",
        "left",
    )
    return timed.select(
        "symbol", "time", *[F.col(f"price_{m}").alias(m) for m in ("open", "high", "low", "close", "volume")]
    )


def scd4_rename(
    act: DataFrame, hist: DataFrame, renames: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Apply ``(old_name, new_name, at)`` renames; returns both tables as they are then.

    The current table takes the new name. The open history row of the symbol is
    closed and one for the new name opened, found by the symbol's id. Renames
    of names that are not current have no effect.
    """
    changes = act.join(renames, act["symbol_name"] == renames["old_name"]).select("symbol_id", "new_name", "at").distinct()
    # Several renames of a symbol follow each other by time, then by name: each
    # closes the one before, the last one is current.
    in_order = Window.partitionBy("symbol_id").orderBy("at", "new_name")
    changes = changes.withColumn("_until", F.lead("at").over(in_order))
    first = changes.groupBy("symbol_id").agg(F.min("at").alias("at"))
    last = changes.withColumn("_last", F.lead(F.lit(1)).over(in_order)).filter("_last IS NULL").select("symbol_id", "new_name")
    new_act = (
        act.join(last, "symbol_id", "left")
        .withColumn("symbol_name", F.coalesce("new_name", "symbol_name"))
        .select(*act.columns)
    )
    closing = F.col("symbol_valid_to").isNull() & F.col("at").isNotNull()
    closed = (
        hist.join(first, "symbol_id", "left")
        .withColumn("symbol_valid_to", F.when(closing, F.col("at")).otherwise(F.col("symbol_valid_to")))
        .select(*hist.columns)
    )
    types = {f.name: f.dataType for f in hist.schema}
    opened = changes.select(
        F.col("symbol_id"),
        F.col("new_name").alias("symbol_name"),
        F.col("at").cast(types["symbol_valid_from"]).alias("symbol_valid_from"),
        F.col("_until").cast(types["symbol_valid_to"]).alias("symbol_valid_to"),
    )
    return new_act, closed.unionByName(opened)
