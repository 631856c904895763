"""Daily marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import to_day
from tidemark.operators.aggregates import earliest_at_max, earliest_at_min, pct_change, ratio
from tidemark.operators.filters import day_slice
from tidemark.operators.joins import asof_join

BASE_CURRENCY = "420"


def daily_price_change(bars: DataFrame, literal: bool = False) -> DataFrame:
    """Per symbol and day: volume, open, close, change, largest volume's time, extremes.

    All measures come from one aggregation. By default "close" is the close of
    the day's last bar and the times of the highest and lowest price are given;
    ``literal`` takes the last bar's open instead and leaves those times out,
    as the view defines it.
    """
    days = bars.withColumn("day", to_day("time"))
    last = "open" if literal else "close"
    measures = [
        F.sum("volume").alias("sum_vol"),
        F.min_by("open", "time").alias("price_open"),
        F.max_by(last, "time").alias("price_close"),
        earliest_at_max("time", "volume").alias("min_vol_time" if literal else "max_vol_time"),
        F.max("high").alias("max_price"),
        F.min("low").alias("min_price"),
    ]
    if not literal:
        measures += [
            earliest_at_max("time", F.col("high") * 10_000).alias("max_price_time"),
            earliest_at_min("time", F.col("low") * 10_000).alias("min_price_time"),
        ]
    mart = days.groupBy("symbol", "day").agg(*measures)
    return mart.withColumn("change_per", pct_change("price_open", "price_close"))


def _daily_totals(tx: DataFrame) -> DataFrame:
    """Counts over all done rows; sums and accounts over those with a positive amount."""
    paid = F.col("amount") > 0
    days = tx.filter(F.col("status") == "done").groupBy(
        to_day("transaction_dt").alias("date_update"), F.col("currency_code").alias("currency_from")
    )
    totals = days.agg(
        F.count("operation_id").alias("cnt_transactions"),
        F.sum(F.when(paid, F.col("amount"))).alias("amount"),
        F.count_distinct(F.when(paid, F.col("account_number_from"))).alias("cnt_accounts_make_transactions"),
    )
    return totals.filter(F.col("amount").isNotNull())


def day_rates(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Rates against the base currency, the latest of each day."""
    return (
        rates.filter(F.col("currency_code_with") == base)
        .groupBy("currency_code", to_day("date_update").alias("rate_day"))
        .agg(F.max_by("currency_with_div", "date_update").alias("currency_with_div"))
    )


def daily_currency_metrics(
    tx: DataFrame,
    rates: DataFrame,
    day: dt.date | str | None = None,
    base: str = BASE_CURRENCY,
    mode: str = "as_of",
) -> DataFrame:
    """Per day and currency: converted amount, transactions, per account, accounts.

    ``as_of`` converts with the currency's latest rate on or before the day.
    ``literal`` converts every currency with the one latest rate found for any
    traded currency, as the mart's SQL reads. Rates are looked up for the
    totals, so their number does not depend on the number of transactions.
    """
    totals = _daily_totals(tx if day is None else day_slice(tx, "transaction_dt", day))
    if mode == "as_of":
        priced = asof_join(
            totals.withColumnRenamed("currency_from", "currency_code"),
            day_rates(rates, base),
            "currency_code",
            "date_update",
            "rate_day",
            ["currency_with_div"],
            how="inner",
        ).withColumnRenamed("currency_code", "currency_from")
    else:
        # The latest usable rate of any traded currency, by one aggregate over rates up to each currency's last done day.
        last_day = (
            tx.filter(F.col("status") == "done")
            .groupBy("currency_code")
            .agg(F.max(to_day("transaction_dt")).alias("_last"))
        )
        usable = rates.filter(F.col("currency_code_with") == base).join(last_day, "currency_code").filter(
            to_day("date_update") <= F.col("_last")
        )
        latest = usable.agg(F.max_by("currency_with_div", F.struct("date_update", "currency_code")))
        traded = usable.select(F.col("currency_code").alias("currency_from")).distinct()
        priced = totals.join(traded, "currency_from", "left_semi").withColumn("currency_with_div", latest.scalar())
    return priced.select(
        "date_update",
        "currency_from",
        (F.col("amount").cast("decimal(20,0)") * F.col("currency_with_div")).alias("amount_total"),
        "cnt_transactions",
        ratio("cnt_transactions", "cnt_accounts_make_transactions").alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
    )


def asof_rate_per_tx(tx: DataFrame, rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Every transaction with the rate valid on its day, NULL where none is."""
    return asof_join(
        tx.withColumn("_day", to_day("transaction_dt")),
        day_rates(rates, base),
        "currency_code",
        "_day",
        "rate_day",
        ["rate_day", "currency_with_div"],
    ).drop("_day")
