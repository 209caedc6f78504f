"""Streams on message files: defects, repeats, failures and restarts."""

import json
import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import timeseries
from sensorlake.plans import live
from sensorlake.sources import archive
from sensorlake.streaming import jobs, messages, sinks

DAY = "2026-02-10T10:{:02d}:00"


def message(mote=1, minute=0, **fields):
    body = {
        "mote_id": mote,
        "timestamp": "2004-03-01T10:00:00",
        "updated_timestamp": DAY.format(minute),
        "temperature": 20.0 + minute,
        "humidity": 50.0,
        "light": None,
        "voltage": 2.7,
        "epoch": minute,
    }
    body.update(fields)
    return json.dumps(body)


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


class Run:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.topic = spark, str(tmp_path / "topic")
        self.hot, self.cold = str(tmp_path / "hot"), str(tmp_path / "cold")
        self.rejects, self.checkpoint = str(tmp_path / "rejects"), str(tmp_path / "cp")
        self.options = options

    def __call__(self, sink=None):
        sink = sink or sinks.DualSink(self.hot, self.cold, self.rejects, **self.options)
        stream = messages.read_files(self.spark, self.topic)
        jobs.ingest(stream, sink, self.checkpoint).awaitTermination()
        return sink

    def values(self, field="temperature"):
        rows = sinks.hot_view(self.spark, self.hot).filter(F.col("_field") == field)
        return sorted((r["mote_id"], r["_time"].minute, r["_value"]) for r in rows.collect())

    def archived(self):
        rows = archive.read_mote_archive(self.spark, self.cold).collect()
        return sorted((r["mote_id"], r["updated_timestamp"].minute, r["temperature"]) for r in rows)


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def test_first_in_archive_last_in_hot_store(run):
    put(run.topic, "a", message(1, 0), message(1, 0, temperature=99.0), message(2, 1))
    run()
    assert run.values() == [("1", 0, 99.0), ("2", 1, 21.0)]
    assert run.archived() == [(1, 0, 20.0), (2, 1, 21.0)]


def test_rejects(run, spark):
    put(
        run.topic, "a", message(1, 0), '{"mote_id": 1, "temp', message(None, 1),
        message(1, 2, temperature=None, humidity=None, voltage=None),
        message(1, 3, updated_timestamp=None, timestamp=None),
        message(1, 4, updated_timestamp="yesterday"),
        message(1, 5, updated_timestamp=""),
    )
    run()
    rows = spark.read.schema("value string, reject string").parquet(run.rejects).collect()
    assert sorted(r["reject"] for r in rows) == [
        "malformed", "no metric", "no mote id", "no time", "unreadable time",
    ]
    assert [v[:2] for v in run.values()] == [("1", 0), ("1", 0)]
    assert len(run.archived()) == 3


def test_restart_continues(run):
    put(run.topic, "a", message(1, 0))
    run()
    put(run.topic, "b", message(1, 0, temperature=50.0), message(1, 1))
    run()
    run()
    assert run.values() == [("1", 0, 50.0), ("1", 1, 21.0)]
    assert run.archived() == [(1, 0, 20.0), (1, 1, 21.0)]
    sinks.fold_hot(run.spark, run.hot)
    assert run.values() == [("1", 0, 50.0), ("1", 1, 21.0)]
    assert sinks.read_hot(run.spark, run.hot).select("source").distinct().count() == 1
    put(run.topic, "c", message(1, 1, temperature=7.0))
    run()
    assert run.values() == [("1", 0, 50.0), ("1", 1, 7.0)]


def test_two_sources_share_a_store(run, tmp_path):
    put(run.topic, "a", message(1, 0), message(1, 1))
    run()
    run.topic, run.checkpoint = str(tmp_path / "topic2"), str(tmp_path / "cp2")
    put(run.topic, "a", message(1, 1, temperature=50.0), message(2, 2))
    run()
    assert run.values() == [("1", 0, 20.0), ("1", 1, 50.0), ("2", 2, 22.0)]
    assert run.archived() == [(1, 0, 20.0), (1, 1, 21.0), (2, 2, 22.0)]


def test_questions_read_only_their_days(run, spark):
    put(run.topic, "a", message(1, 0), message(1, 1, updated_timestamp="2020-01-01T00:03:00"))
    run()
    as_of = datetime(2026, 2, 10, 12)
    found = timeseries.select_points(sinks.hot_view(spark, run.hot), as_of, "-3h")
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert "date" in filters[1] and found.count() == 3


def test_files_count_in_the_order_of_their_time(run):
    put(run.topic, "z", message(1, 0), message(1, 0, temperature=1.0))
    put(run.topic, "a", message(1, 0, temperature=2.0))
    os.utime(os.path.join(run.topic, "z"), (1, 1))
    run()
    assert run.values() == [("1", 0, 2.0)] and run.archived() == [(1, 0, 20.0)]


def test_late_rows_are_stored(run):
    put(run.topic, "a", message(1, 30))
    run()
    put(run.topic, "b", message(1, 3, updated_timestamp="2020-01-01T00:03:00"))
    run()
    assert len(run.values()) == len(run.archived()) == 2


def test_failed_archive_write_is_repaired(run, spark, monkeypatch):
    put(run.topic, "a", message(1, 0), message(2, 1))

    def fail(*_):
        raise OSError("store is down")

    with monkeypatch.context() as m:
        m.setattr(sinks, "archive_new", fail)
        run()
    assert len(run.values()) == 2 and not os.path.exists(run.cold)
    assert sinks.retry_pending(spark, run.hot, run.cold) > 0
    assert sinks.retry_pending(spark, run.hot, run.cold) == 0
    assert run.archived() == [(1, 0, 20.0), (2, 1, 21.0)]
    rows = archive.read_mote_archive(spark, run.cold).orderBy("epoch").collect()
    assert [(r["epoch"], r["timestamp"].year) for r in rows] == [(0, 2004), (1, 2004)]


def test_archive_is_repaired_from_the_hot_store(run, spark):
    put(run.topic, "a", message(1, 0), message(2, 1))
    run()
    other = run.cold + "2"
    for _ in range(2):
        sinks.repair_archive(spark, sinks.hot_view(spark, run.hot), other)
    run.cold = other
    assert run.archived() == [(1, 0, 20.0), (2, 1, 21.0)]


def test_failed_hot_write_is_replayed(run, monkeypatch):
    put(run.topic, "a", message(1, 0), message(2, 1))

    def fail(*_):
        raise OSError("store is down")

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_hot", fail)
        with pytest.raises(Exception, match="store is down"):
            run()
    assert not os.path.exists(run.cold)
    run()
    assert len(run.values()) == len(run.archived()) == 2


def test_dedup_stream(spark, tmp_path):
    topic, out = str(tmp_path / "t"), str(tmp_path / "o")
    put(topic, "a", message(1, 0), message(1, 0, temperature=5.0), message(1, 1))

    def go():
        stream = messages.read_files(spark, topic, files_per_batch=1)
        jobs.write_deduplicated(stream, out, str(tmp_path / "cp")).awaitTermination()
        rows = spark.read.parquet(out).select("mote_id", "event_time", "temperature").collect()
        return sorted((r[1].year, r[1].minute, r[2]) for r in rows)

    assert go() == [(2026, 0, 20.0), (2026, 1, 21.0)]
    # far behind everything seen, and repeats of both batches
    put(topic, "b", message(1, 1, temperature=9.0), message(1, 2), message(1, 3, updated_timestamp="2020-01-01T00:03:00"))
    put(topic, "c", message(1, 3, updated_timestamp="2020-01-01T00:03:00", temperature=0.5))
    assert go() == [(2020, 3, 23.0), (2026, 0, 20.0), (2026, 1, 21.0), (2026, 2, 22.0)]


def test_dedup_state(spark, tmp_path):
    """Many small batches: late repeats are dropped after a restart, ties go to the first."""
    topic, out = str(tmp_path / "t"), str(tmp_path / "o")

    def go():
        stream = messages.read_files(spark, topic, files_per_batch=1)
        query = jobs.write_deduplicated(stream, out, str(tmp_path / "cp"))
        query.awaitTermination()
        rows = spark.read.parquet(out).select("mote_id", "event_time", "temperature", "epoch")
        return sorted(tuple(r) for r in rows.collect()), query

    for i in range(6):
        put(topic, f"f{i}", message(1, i, temperature=i / 3), message(1, 0, temperature=99.0),
            message(2, i), message(1, i, temperature=77.0))
        os.utime(os.path.join(topic, f"f{i}"), (1000 + i, 1000 + i))  # files of one time have no order
    first, _ = go()
    assert [r[2] for r in first if r[0] == 1] == [i / 3 for i in range(6)]
    assert len(first) == 12
    put(topic, "late", message(1, 2, temperature=55.0), message(2, 5), message(3, 0))
    again, query = go()
    assert [r for r in again if r[0] != 3] == first and len(again) == 13
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3


def test_order_across_batches(spark, tmp_path):
    topic, out = str(tmp_path / "t"), str(tmp_path / "o")
    put(topic, "a", message(1, 0, epoch=1), message(1, 1, epoch=2), message(2, 0, epoch=9))
    put(topic, "b", message(1, 2, epoch=2), message(2, 1, epoch=8), message(2, 2, epoch=10))
    put(topic, "c", message(None, 3, epoch=4), message(1, 3, epoch=1),
        message(None, 3, epoch=1), message(7, 1)[:-2])
    for i, name in enumerate("abc"):
        os.utime(os.path.join(topic, name), (1000 + i, 1000 + i))
    stream = messages.read_files(spark, topic, files_per_batch=1)
    jobs.write_order_counts(stream, out, str(tmp_path / "cp")).awaitTermination()
    sums = spark.read.parquet(out).groupBy("key").agg(F.sum("n_messages"), F.sum("n_out_of_order"))
    assert sorted(map(tuple, sums.collect()), key=str) == [("1", 4, 1), ("2", 3, 1), (None, 2, 1)]


def test_minute_means(spark, tmp_path):
    topic, parts = str(tmp_path / "t"), str(tmp_path / "p")
    for name, value in (("a", 10.0), ("b", 30.0)):
        put(topic, name, message(1, 0, temperature=value), message(2, 0, temperature=value))
        stream = messages.read_files(spark, topic)
        jobs.write_minute_parts(stream, parts, str(tmp_path / "cp")).awaitTermination()
    means = jobs.minute_means(spark.read.parquet(parts)).filter("_field = 'temperature'").collect()
    assert [(r["mote_id"], r["_time"].minute, r["_value"]) for r in means] in (
        [("1", 1, 20.0), ("2", 1, 20.0)], [("2", 1, 20.0), ("1", 1, 20.0)],
    )


def test_windows_close_behind_the_watermark(spark, tmp_path):
    topic, out = str(tmp_path / "t"), str(tmp_path / "o")
    put(topic, "a", *[message(1, m) for m in (0, 0, 5, 59)])
    parsed = messages.parse(messages.read_files(spark, topic))
    means = jobs.live_minute_mean(parsed, "temperature", "10 minutes")
    jobs.to_files(means, out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["_time"].minute for r in spark.read.parquet(out).collect()) == [1, 6]


FULL = "2012-09-14 08:27:33.90125 47 {} 18.5 52.25 96.0 2.5 2029-04-08T08:27:33.901250"


def test_backfill(spark, tmp_path):
    source, hot, cold = (str(tmp_path / n) for n in ("s", "h", "c"))
    put(source, "a", FULL.format(1), FULL.format(2), "too short", "2012-09-14 08:29:02.4 1 2029-04-09T11:52:40.16")
    for _ in range(2):
        jobs.backfill(spark, source, sinks.DualSink(hot, cold), str(tmp_path / "cp")).awaitTermination()
    assert sinks.read_hot(spark, hot).count() == 8
    assert archive.read_mote_archive(spark, cold).count() == 3
    lines = spark.read.text(source).withColumnRenamed("value", "line")
    report = jobs.backfill_report(jobs.text_messages(lines)).first()
    assert tuple(report) == (4, 2, 8, 3, 2)


def test_backfill_cold_only(spark, tmp_path):
    source, hot, cold = (str(tmp_path / n) for n in ("s", "h", "c"))
    put(source, "a", FULL.format(1))
    sink = sinks.DualSink(hot, cold, cold_only=True)
    jobs.backfill(spark, source, sink, str(tmp_path / "cp")).awaitTermination()
    assert not os.path.exists(hot) and archive.read_mote_archive(spark, cold).count() == 1


def test_message_round_trip(spark):
    rows = spark.createDataFrame(
        [(1, 7, None, 1.5)], "mote_id int, epoch long, light double, temperature double"
    ).selectExpr(
        "*", "timestamp_ntz'2004-02-29 00:00:00' as timestamp",
        "timestamp_ntz'2026-02-28 00:00:00.25' as updated_timestamp",
        "cast(null as double) as humidity", "2.5D as voltage",
    )
    sent = messages.to_messages(rows).first()
    body = json.loads(sent["value"])
    assert sent["key"] == "1" and "light" not in body
    assert body["timestamp"] == "2004-02-29T00:00:00"
    assert body["original_timestamp"] == "2004-02-29T00:00:00.000000"
    assert body["updated_timestamp"] == "2026-02-28T00:00:00.250000"
    parsed = messages.parse(messages.to_messages(rows)).first()
    assert parsed["reject"] is None and parsed["epoch"] == 7


def test_null_payload_is_skipped(spark):
    df = spark.createDataFrame([(None,), (message(),)], "value string")
    assert messages.parse(df).count() == 1


def test_broker_options():
    source = messages.kafka_source_options("b:9092", per_batch=100)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "100"
    assert messages.kafka_sink_options("b:9092")["topic"] == "sensor_readings"
    assert jobs.batch_trigger() == {"processingTime": "1.0 seconds"}


def test_message_files_are_bounded(spark, tmp_path):
    """One row group becomes several files; events of one time stay in one of them, in order."""
    events = spark.range(1200).selectExpr(
        "id as event_id", "id % 7 as user_id", "double(id) as value",
        "cast(timestamp_seconds(1700000000 + id % 300) as timestamp_ntz) as ts",
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    path = live._topic(spark, str(tmp_path), events_per_file=200)
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    sizes = [r["count"] for r in lines.groupBy("file").count().collect()]
    assert sum(sizes) == 1200 + len(range(0, 1200, 29))
    assert len(sizes) > 3 and max(sizes) < 450
    times = F.from_json("value", messages.MESSAGE)["timestamp"].alias("at")
    places = lines.select("file", times).filter("at is not null").groupBy("at")
    assert places.agg(F.countDistinct("file").alias("n")).agg(F.max("n")).first()[0] == 1
