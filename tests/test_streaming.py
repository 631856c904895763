"""Streams from files, restarted and with late and repeated messages."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import ENVELOPE
from tidemark.sources import events
from tidemark.streaming import ingest

START = dt.datetime(2024, 1, 1, 12)


def message(i, minute, kind="TRANSACTION", payload=None):
    return json.dumps(
        {"object_id": str(i), "object_type": kind, "sent_dttm": str(START + dt.timedelta(minutes=minute)), "payload": payload or {"n": i}}
    )


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        (root / "in").mkdir()

    def put(self, *messages):
        self.n += 1
        (self.root / "in" / f"{self.n:03}.json").write_text("\n".join(messages))

    def run(self, dedup=ingest.dedup_stream, sink=None, out="out"):
        schema = self.spark.createDataFrame([], "value string").schema
        raw = events.read_event_files(self.spark, str(self.root / "in"), schema, "text")
        stream = dedup(events.decode_envelope(raw, ENVELOPE))
        sink = sink or ingest.write_microbatch(str(self.root / out))
        query = ingest.start(stream, sink, str(self.root / "checkpoint"), interval=None)
        query.awaitTermination()
        return query

    def ids(self, out="out"):
        return sorted(r[0] for r in self.spark.read.parquet(str(self.root / out)).select("object_id").collect())


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_duplicates_and_broken_messages(feed):
    feed.put(message(1, 0), message(1, 0), message(1, 1), "{broken", message(2, 0), '{"object_id": "3"}')
    feed.run()
    # Another time makes another message.
    assert feed.ids() == ["1", "1", "2"]


def test_restart_continues(feed):
    feed.put(message(1, 0))
    feed.run()
    feed.put(message(1, 0), message(2, 0))
    feed.run()
    feed.run()
    assert feed.ids() == ["1", "2"]


def test_late_rows_are_dropped_and_counted(feed):
    feed.put(message(1, 60))
    feed.run()
    feed.put(message(2, 0), message(3, 61))
    query = feed.run()
    assert feed.ids() == ["1", "3"]
    assert ingest.late_row_count(query) == 1
    row = ingest.progress_row(query)
    assert row["active"] is False and row["late_rows"] == 1


def test_key_only_dedup_within_watermark(feed):
    feed.put(message(1, 0), message(1, 0.5), message(2, 0))
    feed.run(lambda df: ingest.dedup_stream(df, ["object_id"], within_watermark=True))
    assert feed.ids() == ["1", "2"]


def test_fan_out(feed, spark, tmp_path):
    feed.put(message(1, 0), message(2, 0, "CURRENCY"), message(3, 0, "OTHER"))
    feed.run(sink=ingest.fan_out(str(tmp_path / "out"), ["TRANSACTION", "CURRENCY"]))
    assert feed.ids("out/sink=TRANSACTION") == ["1"] and feed.ids("out/sink=CURRENCY") == ["2"]
    assert feed.ids() == ["1", "2"]


def test_fan_out_reads_a_batch_once(spark, tmp_path):
    rows = [("1", "T", START, "{}"), ("2", "C", START, "{}"), ("3", "X", START, "{}")]
    seen = spark.sparkContext.accumulator(0)
    schema = "object_id string, object_type string, sent_dttm timestamp, payload string"

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sink = ingest.fan_out(str(tmp_path / "out"), ["T", "C"])
    for _ in range(2):
        sink(spark.createDataFrame(rows, schema).mapInArrow(count, schema), 4)
    assert seen.value == 6 and spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_progress_log(feed, spark, tmp_path):
    feed.put(message(1, 60))
    with ingest.ProgressLog(spark, str(tmp_path / "log")):
        feed.run()
        feed.put(message(2, 0), message(3, 61))
        query = feed.run()
    feed.put(message(4, 62))
    feed.run()
    rows = ingest.read_progress(spark, str(tmp_path / "log")).collect()
    assert sum(r["input_rows"] for r in rows) == 3 and sum(r["late_rows"] for r in rows) == 1
    assert len({r["run_id"] for r in rows}) == 2 and {r["query_id"] for r in rows} == {str(query.id)}


def test_batch_run_twice_is_written_once(spark, tmp_path):
    sink = ingest.write_microbatch(str(tmp_path / "out"))
    batch = spark.createDataFrame([("1", "T", START, "{}")], "object_id string, object_type string, sent_dttm timestamp, payload string")
    sink(batch, 7)
    sink(batch, 7)
    sink(batch, 8)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_state_is_bounded(feed, spark):
    feed.put(*[message(i, i) for i in range(50)])
    feed.run()
    feed.put(message(100, 600))
    feed.run()
    feed.put(message(101, 601))
    query = feed.run()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept and kept[-1] <= 3


def test_interval_trigger(feed, spark, tmp_path):
    feed.put(message(1, 0))
    schema = spark.createDataFrame([], "value string").schema
    stream = ingest.dedup_stream(events.decode_envelope(events.read_event_files(spark, str(tmp_path / "in"), schema, "text")))
    query = ingest.start(stream, ingest.write_microbatch(str(tmp_path / "out")), str(tmp_path / "c"), "1 second", "ticking")
    try:
        query.processAllAvailable()
        assert ingest.progress_row(query)["active"] and query.name == "ticking"
    finally:
        query.stop()
    assert feed.ids() == ["1"]


def test_topic_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        events.read_event_stream(spark, {"kafka.bootstrap.servers": "none:1"}, "t", 10)


def test_read_messages(spark):
    rows = [("1", "T", START, "{}"), ("2", "C", START, "{}"), ("3", "T", START + dt.timedelta(days=1), "{}")]
    stored = spark.createDataFrame(rows, "object_id string, object_type string, sent_dttm timestamp, payload string")
    assert [r["object_id"] for r in events.read_messages(stored, "2024-01-01", "T").collect()] == ["1"]
    assert stored.filter(F.col("object_type") == "C").count() == 1
