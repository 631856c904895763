"""Event envelopes from a topic, a file stream or a stored message table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import day_slice
from tidemark.schemas import ENVELOPE


def read_event_stream(
    spark: SparkSession, options: Mapping[str, str], topic: str, max_per_trigger: int | None = None
) -> DataFrame:
    """Subscribe to one topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options).option("subscribe", topic)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def read_event_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files arriving in a folder, as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def decode_envelope(df: DataFrame, schema: T.StructType = ENVELOPE, value: str = "value") -> DataFrame:
    """Message bytes to envelope columns, with the payload kept as JSON text.

    A message that is not such JSON becomes a row of NULLs.
    """
    decoded = df.select(F.from_json(F.col(value).cast("string"), schema).alias("message")).select("message.*")
    return decoded.withColumn("payload", F.to_json("payload"))


def read_messages(messages: DataFrame, date: dt.date | str, object_type: str) -> DataFrame:
    """Stored messages of one day and one object type."""
    return day_slice(messages, "sent_dttm", date).filter(F.col("object_type") == object_type)


def read_message_table(
    spark: SparkSession, options: Mapping[str, str], id_bounds: tuple[int, int], partitions: int
) -> DataFrame:
    """The message table over JDBC, read in parallel by ranges of its id."""
    low, high = id_bounds
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("partitionColumn", "id")
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )
