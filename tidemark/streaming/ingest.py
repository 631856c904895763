"""De-duplicated ingestion of event envelopes with bounded state."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.filters import drop_incomplete
from tidemark.scale import write_text
from tidemark.schemas import MESSAGE_COLUMNS

BatchSink = Callable[[DataFrame, int], None]


def with_event_watermark(df: DataFrame, col: str = "sent_dttm", delay: str = "1 minute") -> DataFrame:
    return df.withWatermark(col, delay)


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = ("object_id", "sent_dttm"),
    ts: str = "sent_dttm",
    delay: str = "1 minute",
    within_watermark: bool = False,
) -> DataFrame:
    """Drop repeated messages.

    The watermark comes first and the event time is part of the key, so state
    older than the delay is dropped. With ``within_watermark`` the key alone
    decides, and repeats count only while the watermark keeps the first one.
    """
    marked = with_event_watermark(df, ts, delay)
    if within_watermark:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    return marked.dropDuplicates(sorted({*keys, ts}))


def _query_id(df: DataFrame) -> str:
    """Id of the running stream, which stays the same over restarts from its checkpoint."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_microbatch(path: str, cols: Sequence[str] = MESSAGE_COLUMNS, ts: str = "sent_dttm") -> BatchSink:
    """Batch sink: the message columns of complete rows, by day and batch.

    A batch is named by its stream and its number. Run again after a failure
    it replaces its own folders, so the table holds every row once; a stream
    with a new checkpoint has another name and replaces nothing.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        rows = drop_incomplete(batch.select(*cols), cols)
        rows = rows.withColumns({"day": F.to_date(ts), "batch": F.lit(f"{_query_id(batch)}-{epoch_id}")})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)

    return write


def fan_out(path: str, types: Sequence[str], type_col: str = "object_type", cols: Sequence[str] = MESSAGE_COLUMNS, ts: str = "sent_dttm") -> BatchSink:
    """Batch sink: the rows of each type in a folder of their own, by day and batch.

    All types go out in one write, so a batch is read once. Rows of other
    types are not written. A batch run again replaces its own folders.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        wanted = batch.where(F.col(type_col).isin(*types)).select(*dict.fromkeys([*cols, type_col]))
        rows = drop_incomplete(wanted, cols)
        rows = rows.withColumns({"sink": F.col(type_col), "day": F.to_date(ts), "batch": F.lit(f"{_query_id(batch)}-{epoch_id}")})
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("sink", "day", "batch").parquet(path)

    return write


def start(
    df: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    interval: str | None = "15 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Start a restartable query; without an interval it drains its source and ends."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


PROGRESS = (
    "name string, query_id string, run_id string, batch_id bigint, at timestamp, input_rows bigint, rows_per_second double,"
    " late_rows bigint, state_rows bigint, watermark string"
)


class ProgressLog(StreamingQueryListener):
    """Appends every progress of every query to a folder, one JSON file per run and batch.

    All batches are kept, also those a query itself no longer remembers. A
    batch that is reported again replaces its file. Use it as a context to
    have it removed, with all reports in, at the end.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        # Reports come after the batch, on a queue of their own.
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        last = event.progress
        row = {
            "name": last.name, "query_id": str(last.id), "run_id": str(last.runId), "batch_id": last.batchId, "at": last.timestamp,
            "input_rows": last.numInputRows, "rows_per_second": last.processedRowsPerSecond,
            "late_rows": sum(op.numRowsDroppedByWatermark for op in last.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in last.stateOperators), "watermark": last.eventTime.get("watermark"),
        }
        write_text(self._spark, f"{self._path}/{row['run_id']}-{row['batch_id']}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Rows that a ``ProgressLog`` wrote: one per run and batch."""
    return spark.read.schema(PROGRESS).json(path)


def late_row_count(query: StreamingQuery) -> int:
    """Rows dropped for being older than the watermark, in the batches that the query still remembers."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


def progress_row(query: StreamingQuery) -> dict | None:
    """Latest progress of a query, flat."""
    last = query.lastProgress
    if last is None:
        return None
    return {
        "run_id": str(query.runId),
        "batch_id": last["batchId"],
        "active": query.isActive,
        "status": query.status["message"],
        "input_rows": last["numInputRows"],
        "rows_per_second": last["processedRowsPerSecond"],
        "late_rows": late_row_count(query),
    }
