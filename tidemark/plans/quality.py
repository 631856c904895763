"""Reconciliation of staging and core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import row_counts, totals
from tidemark.operators.sets import union_tagged

MEASURES = ["open", "high", "low", "close", "volume"]


def _presence(layer: str) -> Column:
    return F.bool_or(F.col("layer") == layer)


def check_symbols(staging: DataFrame, core: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Symbols found in only one of the layers."""
    both = union_tagged({"staging": staging.select(symbol).distinct(), "core": core.select(symbol).distinct()})
    return (
        both.groupBy(symbol)
        .agg(_presence("staging").alias("in_staging"), _presence("core").alias("in_core"))
        .filter(F.col("in_staging") != F.col("in_core"))
    )


def check_counts(staging: DataFrame, core: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows per symbol in each layer."""
    return union_tagged({"staging": row_counts(staging, [symbol], "rows"), "core": row_counts(core, [symbol], "rows")})


def check_ohlcv(staging: DataFrame, core: DataFrame, symbol: str = "symbol", time: str = "time") -> DataFrame:
    """Sums per symbol, day and layer, with whether both layers agree."""

    def sums(layer: DataFrame) -> DataFrame:
        return totals(layer.withColumn("date", F.to_date(time)), [symbol, "date"], MEASURES)

    def as_row(layer: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.struct(*MEASURES)))

    both = union_tagged({"staging": sums(staging), "core": sums(core)})
    paired = both.groupBy(symbol, "date").agg(as_row("staging").alias("_s"), as_row("core").alias("_c"))
    layers = F.filter(
        F.array(
            F.struct(F.lit("staging").alias("layer"), F.col("_s").alias("sums")),
            F.struct(F.lit("core").alias("layer"), F.col("_c").alias("sums")),
        ),
        lambda entry: entry["sums"].isNotNull(),
    )
    rows = paired.withColumn("matches", F.col("_s").eqNullSafe(F.col("_c"))).withColumn("_l", F.explode(layers))
    return rows.select(
        symbol, "date", F.col("_l.layer").alias("layer"), *[F.col(f"_l.sums.{m}").alias(m) for m in MEASURES], "matches"
    )
