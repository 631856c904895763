"""Price bars from CSV and JSON downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import local_to_utc
from tidemark.schemas import PRICE, PRICE_JSON_FIELDS, PRICE_TEXT
from tidemark.sinks.quarantine import copy_with_rejects

ZONE = "US/Eastern"


def typed_bars(text_bars: DataFrame, zone: str = ZONE) -> DataFrame:
    """Text bars in local time to typed bars in UTC; other columns stay."""
    extra = [c for c in text_bars.columns if c not in PRICE.names]
    return text_bars.select(
        *extra,
        local_to_utc("time", zone).alias("time"),
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in PRICE if f.name != "time"],
    )


def checked_bars(text_bars: DataFrame, zone: str = ZONE) -> tuple[DataFrame, DataFrame]:
    """Typed bars in UTC, and apart from them the rows with a cell that does not parse or without time."""
    utc = F.date_format(local_to_utc("time", zone), "yyyy-MM-dd HH:mm:ss")
    return copy_with_rejects(text_bars.withColumn("time", F.coalesce(utc, "time")), PRICE, ["time"])


def read_checked_csv(spark: SparkSession, path: str, zone: str = ZONE) -> tuple[DataFrame, DataFrame]:
    """Header CSV as typed bars, and the rows that are none with their reason."""
    text = spark.read.csv(path, header=True, schema=PRICE_TEXT)
    return checked_bars(text.withColumn("file", F.col("_metadata.file_path")), zone)


def read_price_csv(spark: SparkSession, path: str, zone: str = ZONE) -> DataFrame:
    """Header CSV, every column read as text and then typed."""
    text = spark.read.csv(path, header=True, schema=PRICE_TEXT)
    return typed_bars(text.withColumn("file", F.col("_metadata.file_path")), zone)


def bars_from_json(docs: DataFrame, col: str, interval: str = "5min", zone: str = ZONE) -> DataFrame:
    """One row per time key of the price documents in a text column."""
    key = f"Time Series ({interval})"
    shape = f"struct<`{key}`:map<string,map<string,string>>>"
    rest = [c for c in docs.columns if c != col]
    rows = docs.select(*rest, F.explode(F.from_json(col, shape)[key]).alias("time", "_bar"))
    return typed_bars(
        rows.select(
            *rest,
            "time",
            *[F.try_element_at("_bar", F.lit(field)).alias(name) for name, field in PRICE_JSON_FIELDS.items()],
        ),
        zone,
    )


def read_price_json(spark: SparkSession, path: str, interval: str = "5min", zone: str = ZONE) -> DataFrame:
    """One document per file, one row per bar; every bar is kept."""
    docs = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return bars_from_json(docs, "value", interval, zone)
