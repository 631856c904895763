"""Whole loads in their proper order, over tables kept as Parquet folders.

Each load may be run again for the same input: tables only take rows they do
not hold, and marts replace the days they are computed for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import distinct_rows
from tidemark.operators.filters import align_schema, day_slice
from tidemark.operators.sets import union_roles
from tidemark.plans import marts, star, vault
from tidemark.plans.staging import stage_messages
from tidemark.scale import delete_path, scratch_path
from tidemark.schemas import LEDGER, STAR, VAULT, VAULT_KEYS
from tidemark.sinks.write import append_bucketed, append_partition, read_bucketed, read_or_empty, replace_table


def stage_day(spark: SparkSession, messages: DataFrame, root: str, day: dt.date | str) -> None:
    """Messages of a day to typed staging tables, rejects and misfits beside them."""
    path = scratch_path(spark, "messages")
    day_slice(messages, "sent_dttm", day).write.parquet(path)
    today = spark.read.parquet(path)
    for object_type, table, ts in (
        ("TRANSACTION", "transactions", "transaction_dt"),
        ("CURRENCY", "currencies", "date_update"),
    ):
        good, bad, misfits = stage_messages(today, object_type)
        # By business day, so that a day's vault load opens that day alone; a rerun replaces what this day sent.
        append_partition(good, f"{root}/{table}", ts, order=[ts], part=("sent_day", str(day)))
        append_partition(bad, f"{root}/{table}_rej", "sent_dttm", days=[day])
        append_partition(misfits, f"{root}/{table}_misfit", "sent_dttm", days=[day])
    delete_path(spark, path)


class _Tables:
    """Tables read as they are now and appended to; those with ``keys`` are bucketed by them."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict, keys: dict | None = None):
        self.spark, self.root, self.schemas, self.keys = spark, root, schemas, keys or {}

    def read(self, name: str) -> DataFrame:
        if name in self.keys:
            return read_bucketed(self.spark, f"{self.root}/{name}", self.schemas[name], self.keys[name])
        return read_or_empty(self.spark, f"{self.root}/{name}", self.schemas[name])

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        rows = align_schema(rows, self.schemas[name])
        if name in self.keys:
            return append_bucketed(rows, f"{self.root}/{name}", self.schemas[name], self.keys[name])
        rows.write.mode("append").parquet(f"{self.root}/{name}")
        return self.read(name)


def _of_day(rows: DataFrame, ts: str, day: dt.date | str) -> DataFrame:
    """A day's rows; where the table is partitioned by ``day``, its other folders are not opened."""
    if "day" in rows.columns:
        rows = rows.filter(F.col("day") == F.lit(str(day)).cast("date"))
    return day_slice(rows, ts, day)


def load_vault_day(
    spark: SparkSession,
    transactions: DataFrame,
    rates: DataFrame,
    root: str,
    day: dt.date | str,
    load_src: str = "messages",
) -> None:
    """Hubs, then links, then satellites of a day."""
    tables = _Tables(spark, root, VAULT, VAULT_KEYS)
    run = F.lit(str(day)).cast("timestamp")
    tx = _of_day(transactions, "transaction_dt", day)
    quotes = _of_day(rates, "date_update", day)

    def hub(name: str, src: DataFrame, key: str, **more) -> DataFrame:
        return tables.append(name, vault.load_hub(tables.read(name), src, key, run, load_src, **more))

    codes = distinct_rows(tx, ["currency_code"]).unionByName(
        union_roles(quotes, ["currency_code", "currency_code_with"], "currency_code")
    )
    accounts = hub("h_accounts", tx, "account_number", roles=["account_number_from", "account_number_to"])
    countries = hub("h_countries", tx.withColumnRenamed("country", "country_name"), "country_name")
    currencies = hub("h_currencies", codes, "currency_code")
    operations = hub(
        "h_transactions", tx, "operation_id",
        attrs=["amount", "transaction_type", "transaction_dt"], event_ts="transaction_dt",
    )

    operation = vault.Ref(operations, "operation_id", "operation_id", "hk_transaction")
    currency = vault.Ref(currencies, "currency_code", "currency_code", "hk_currency")

    def link(name: str, *refs: vault.Ref) -> None:
        tables.append(name, vault.load_link(tables.read(name), tx, [operation, *refs], run, load_src))

    link(
        "l_transaction_account",
        vault.Ref(accounts, "account_number", "account_number_from", "hk_account_from"),
        vault.Ref(accounts, "account_number", "account_number_to", "hk_account_to"),
    )
    link("l_transaction_country", vault.Ref(countries, "country_name", "country", "hk_country"))
    link("l_transaction_currency", currency)

    name = "s_transaction_status"
    statuses = vault.load_satellite(
        tables.read(name), tx, [operation], {"status": "status", "transaction_dt": "status_dt"},
        ["status_dt", "status"], run, load_src,
    )
    tables.append(name, statuses)
    name = "s_currency_div"
    base = vault.Ref(currencies, "currency_code", "currency_code_with", "hk_currency_with")
    values = vault.load_satellite(
        tables.read(name), quotes, [currency, base], {"currency_with_div": "div", "date_update": "date_update"},
        ["date_update"], run, load_src,
    )
    tables.append(name, values)


def load_currency_mart(
    transactions: DataFrame, rates: DataFrame, path: str, day: dt.date | str, mode: str = "as_of"
) -> None:
    """The day's metrics in place of what the mart held for that day."""
    metrics = marts.daily_currency_metrics(transactions, rates, day, mode=mode)
    append_partition(metrics, path, "date_update", days=[day])


def load_prices(spark: SparkSession, bars: DataFrame, interval: str, root: str) -> None:
    """Bars (with ``symbol``) through ledger, staging, dimensions and fact.

    Loads of a symbol, interval and day already in the ledger are refused;
    afterwards the new ones are marked as uploaded. A load that broke off is
    taken up again.
    """
    tables = _Tables(spark, root, {**STAR, "ledger": LEDGER})
    ledger = tables.read("ledger")
    # Days of the bars that are new, or whose load never finished.
    wanted = distinct_rows(bars.select(F.col("symbol").alias("symbol_name"), F.to_date("time").alias("date")), ["symbol_name", "date"])
    wanted = wanted.withColumn("interval_name", F.lit(interval))
    opened = star.open_uploads(ledger, wanted)
    ledger = tables.append("ledger", opened)
    pending = star.pending_uploads(ledger).filter(F.col("interval_name") == interval)
    stocks = star.stamp_uploads(bars, pending)

    def dimension(name: str, values: DataFrame, keys: list[str], id_col: str) -> DataFrame:
        return tables.append(name, star.load_dimension(tables.read(name), values, keys, id_col))

    intervals = dimension("d_interval", pending, ["interval_name"], "interval_id")
    symbols = dimension("d_symbol_act", pending, ["symbol_name"], "symbol_id")
    times = dimension(
        "d_time_serial", star.time_serial_values(stocks, pending, intervals),
        ["time_serial_time", "time_serial_interval_id"], "time_serial_id",
    )
    tables.append("d_symbol_hist", star.open_symbol_history(tables.read("d_symbol_hist"), symbols, pending))
    tables.append("f_price", star.load_fact_price(tables.read("f_price"), stocks, pending, intervals, symbols, times))
    replace_table(star.mark_loaded(ledger, wanted), f"{root}/ledger")


def price_mart(spark: SparkSession, root: str, literal: bool = False) -> DataFrame:
    """The price mart over the loaded star."""
    tables = _Tables(spark, root, STAR)
    bars = star.fact_bars(tables.read("f_price"), tables.read("d_symbol_act"), tables.read("d_time_serial"))
    return marts.daily_price_change(bars, literal)
