"""Queries that run a stream until it has caught up and read its tables.

The stream source is a folder of message files that Spark writes from the events.
"""

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.dedup import last_per_point
from sensorlake.operators.timeseries import to_points
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import MOTES, sql, sql_iso, sql_number
from sensorlake.plans.text import _T
from sensorlake.schemas import METRICS
from sensorlake.session import scratch_path
from sensorlake.sources.archive import read_mote_archive
from sensorlake.sources.snapshots import SnapshotTable
from sensorlake.streaming import jobs, messages
from sensorlake.streaming.latest import LatestTable, write_latest
from sensorlake.streaming.sinks import (
    REPORT,
    DualSink,
    batch_folder,
    hot_view,
    load_report,
    read_hot,
    repair_archive,
)

_MOVED = tables.MOVED.days
_WIDE = ", ".join(f"max(CASE WHEN _field = '{m}' THEN _value END) AS {m}" for m in METRICS)


def _sent(spark, sf_dir, events=None):
    """Messages with defects and repeats, in event order per mote, of all events or these.

    Every 31st is cut off, every 37th lacks its mote, every 41st its metrics, every
    43rd its times, every 47th has an unreadable time. Every 29th is sent twice, the
    second time with another temperature.
    """
    e = F.col("event_id")
    moved = F.col("ts") + F.expr(f"interval {_MOVED} days")
    events = tables.table(spark, sf_dir, "events") if events is None else events
    rows = events.select(
        "event_id",
        F.explode(
            F.when(e % 29 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("copy"),
        F.when(e % 37 > 0, (F.col("user_id") % MOTES + 1).cast("int")).alias("mote_id"),
        e.alias("epoch"),
        F.when(e % 43 > 0, F.col("ts")).alias("timestamp"),
        F.when((e % 43 > 0) & (e % 11 > 0), moved).alias("updated_timestamp"),
        F.when(e % 41 > 0, F.col("value")).alias("value"),
    ).select(
        "*",
        (F.col("value") + F.col("copy")).alias("temperature"),
        F.when(F.col("value").isNotNull() & (e % 3 > 0), (e % 101).cast("double")).alias("humidity"),
        F.lit(None).cast("double").alias("light"),
        F.when(F.col("value").isNotNull(), 2.0 + (e % 15) / 10.0).alias("voltage"),
    )
    cut = F.when(e % 31 == 0, F.expr("substring(value, 1, length(value) - 4)"))
    unreadable = F.when(e % 47 == 0, F.regexp_replace("value", 'stamp":"20', 'stamp":"x'))
    sent = rows.select(
        "event_id",
        "copy",
        F.col("mote_id").cast("string").alias("key"),
        messages.message_body().alias("value"),
    )
    return sent.withColumn("value", F.coalesce(cut, unreadable, F.col("value")))


#: Events per message file; a task sorts the messages of its file.
_EVENTS_PER_FILE = 500_000


def _topic(spark, sf_dir, events_per_file=_EVENTS_PER_FILE):
    """A folder with all messages; each file holds a range of times, of bounded size however
    large the row groups of the table are. Files arrive in any order, so events of one time,
    of which the last counts, stay in one file."""
    path = scratch_path(spark, "topic")
    events = tables.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    files = -(-events.count() // events_per_file)
    if files > 1:
        events = events.repartitionByRange(files, "ts")
    messages.write_files(_sent(spark, sf_dir, events), path, ("key", "event_id", "copy"))
    return path


def _stream(spark, sf_dir):
    return messages.read_files(spark, _topic(spark, sf_dir))


# The same messages in SQL: what the parser should find in each of them.
_PARSED = f"""(SELECT event_id, copy, CASE WHEN event_id % 31 > 0 THEN
      CASE WHEN event_id % 37 > 0 THEN CAST(user_id % {MOTES} + 1 AS INTEGER) END END AS mote_id,
    CASE WHEN event_id % 41 > 0 THEN value + copy END AS temperature,
    CASE WHEN event_id % 41 > 0 AND event_id % 3 > 0 THEN CAST(event_id % 101 AS DOUBLE) END
      AS humidity, CAST(NULL AS DOUBLE) AS light,
    CASE WHEN event_id % 41 > 0 THEN CAST(2 AS DOUBLE) + (event_id % 15) / CAST(10 AS DOUBLE) END
      AS voltage,
    CASE WHEN event_id % 43 > 0 AND event_id % 47 > 0 THEN
      CASE WHEN event_id % 11 > 0 THEN ts + INTERVAL {_MOVED} DAY ELSE ts END END AS event_time,
    CASE WHEN event_id % 31 = 0 THEN 'malformed' WHEN event_id % 37 = 0 THEN 'no mote id'
      WHEN event_id % 41 = 0 THEN 'no metric' WHEN event_id % 43 = 0 THEN 'no time'
      WHEN event_id % 47 = 0 THEN 'unreadable time' END AS reject
    FROM events, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR event_id % 29 = 0)"""
_ACCEPTED = f"(SELECT * FROM {_PARSED} WHERE reject IS NULL)"
_HOT = f"""(SELECT CAST(mote_id AS VARCHAR) AS mote_id, _field, event_time AS _time,
    arg_max(_value, event_id * 2 + copy) AS _value FROM ("""+" UNION ALL ".join(
    f"""SELECT mote_id, '{m}' AS _field, event_time, {m} AS _value, event_id, copy
        FROM {_ACCEPTED} WHERE {m} IS NOT NULL""" for m in METRICS
) + ") GROUP BY 1, 2, 3)"
_COLD = f"""(SELECT mote_id, event_id AS epoch, event_time AS updated_timestamp, temperature,
    humidity, light, voltage FROM {_PARSED}
    WHERE event_id % 31 > 0 AND mote_id IS NOT NULL AND event_time IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY mote_id, event_time ORDER BY event_id, copy) = 1)"""
_METRICS = ", ".join(METRICS)


@query(
    "s8_stream_source",
    f"""SELECT mote_id, event_id AS epoch, event_time, {_METRICS} FROM {_ACCEPTED}""",
)
def stream_source(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "rows"), scratch_path(spark, "checkpoint")
    rows = messages.accepted(messages.parse(_stream(spark, sf_dir)))
    rows = rows.select("mote_id", "epoch", "event_time", *METRICS)
    schema = rows.schema
    jobs.to_files(rows, path, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(path)


@query(
    "s9_stream_sink",
    f"""SELECT CAST(user_id % {MOTES} + 1 AS VARCHAR) AS key, count(*) AS n_messages,
        CAST(sum(event_id) AS BIGINT) AS epochs FROM events GROUP BY 1""",
)
def stream_sink(spark, sf_dir):
    path = scratch_path(spark, "topic")
    messages.write_files(messages.to_messages(tables.complete(spark, sf_dir)), path)
    body = F.from_json("value", messages.MESSAGE).alias("m")
    sent = spark.read.text(path).select(body).select("m.*")
    return sent.groupBy(F.col("mote_id").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum("epoch").alias("epochs")
    )


@query(
    "s10_hot_points",
    f"""SELECT mote_id, _field, _time, _value FROM {_HOT}""",
)
def hot_points(spark, sf_dir):
    hot, _, _, _ = _ingested(spark, sf_dir)
    return hot_view(spark, hot).drop("measurement", "date")


def _ingested(spark, sf_dir):
    hot, cold, rejects = (scratch_path(spark, n) for n in ("hot", "archive", "rejects"))
    sink = DualSink(hot, cold, rejects)
    jobs.ingest(
        _stream(spark, sf_dir), sink, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    return hot, cold, rejects, sink


_FILES = 4


def _four_parts(spark, sf_dir):
    """The messages in four parts, by event id, of ``_FILES`` files each; files come in the
    order they are written."""
    path = scratch_path(spark, "topic")
    for part in range(4):
        sent = _sent(spark, sf_dir).filter(F.col("event_id") % 4 == part)
        messages.write_files(sent.repartition(_FILES), path, ("key", "event_id", "copy"))
    return path


@query(
    "t1_micro_batches",
    f"""SELECT row_number() OVER (ORDER BY p) - 1 AS batch, n AS n_read FROM
        (SELECT event_id % 4 AS p, count(*) AS n FROM {_PARSED} GROUP BY 1)""",
)
def micro_batches(spark, sf_dir):
    """A backlog is taken in batches of bounded size, in order."""
    path, topic = scratch_path(spark, "batches"), _four_parts(spark, sf_dir)

    def write(rows, batch, source):
        counted = rows.agg(F.count(F.lit(1)).alias("n_read"))
        counted.write.mode("overwrite").parquet(batch_folder(path, source, batch))

    stream = messages.parse(messages.read_files(spark, topic, files_per_batch=_FILES))
    checkpoint = scratch_path(spark, "checkpoint")
    jobs.each_batch(stream, write, checkpoint, jobs.UNTIL_CAUGHT_UP).awaitTermination()
    return spark.read.schema(REPORT).parquet(path).select("batch", "n_read")


@query(
    "t6_order_per_mote",
    f"""SELECT key, count(*) AS n_messages, 0 AS n_out_of_order FROM
        (SELECT CASE WHEN event_id % 37 > 0 THEN CAST(user_id % {MOTES} + 1 AS VARCHAR) END AS key,
          unnest([0, 1]) AS copy, event_id FROM events) WHERE (copy = 0 OR event_id % 29 = 0)
          AND event_id % 31 > 0 GROUP BY 1""",
)
def order_per_mote(spark, sf_dir):
    """Messages dealt by key, in three loads of rising ids, arrive in order per mote, also
    across batches; those cut off have no epoch."""
    path, topic = scratch_path(spark, "order"), scratch_path(spark, "topic")
    sent = _sent(spark, sf_dir)
    last = sent.agg(F.max("event_id")).first()[0]
    third = (last or 0) // 3 + 1
    for part in range(3):
        some = sent.filter(F.expr(f"event_id div {third}") == part).repartition(_FILES, "key")
        messages.write_files(some, topic, ("key", "event_id", "copy"))
    stream = messages.read_files(spark, topic, files_per_batch=_FILES)
    jobs.write_order_counts(stream, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).groupBy("key").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_out_of_order").alias("n_out_of_order")
    )


_N_VALUES = " + ".join(f"count({m}) FILTER (reject IS NULL)" for m in METRICS)


@query(
    "a33_load_report",
    f"""SELECT 2 AS n_batches, count(*) AS n_read, {_N_VALUES} AS n_points,
        count(*) FILTER (event_id % 31 > 0 AND mote_id IS NOT NULL AND event_time IS NOT NULL)
          AS n_archive_rows, count(reject) AS n_skipped, 0 AS n_failed FROM {_PARSED}""",
)
def load_totals(spark, sf_dir):
    """What a load read, sent to both stores and skipped."""
    hot, cold, reports = (scratch_path(spark, n) for n in ("hot", "archive", "reports"))
    topic = _four_parts(spark, sf_dir)
    stream = messages.read_files(spark, topic, files_per_batch=2 * _FILES)
    sink = DualSink(hot, cold, reports=reports)
    jobs.ingest(stream, sink, scratch_path(spark, "checkpoint")).awaitTermination()
    return load_report(spark.read.schema(REPORT).parquet(reports))


@query(
    "t2_dual_write",
    f"""SELECT mote_id, epoch, updated_timestamp, {_METRICS} FROM {_COLD}""",
)
def dual_write(spark, sf_dir):
    _, cold, _, _ = _ingested(spark, sf_dir)
    rows = read_mote_archive(spark, cold)
    return rows.select("mote_id", "epoch", "updated_timestamp", *METRICS)


@query(
    "t2_snapshot_ingest",
    f"""SELECT mote_id, epoch, updated_timestamp, {_METRICS} FROM {_COLD}""",
)
def snapshot_ingest(spark, sf_dir):
    """The archive as a snapshot table: some batches, each comparing with its days only;
    then all messages once more from a new checkpoint, which adds nothing; compaction."""
    hot, path = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    table, topic = SnapshotTable(spark, path), _topic(spark, sf_dir)
    n_files = spark.read.text(topic).select(F.col("_metadata.file_path")).distinct().count()
    for files_per_batch in (-(-n_files // 4), n_files):
        stream = messages.read_files(spark, topic, files_per_batch)
        jobs.ingest(stream, DualSink(hot, table), scratch_path(spark, "checkpoint")).awaitTermination()
    table.compact()
    return table.read().select("mote_id", "epoch", "updated_timestamp", *METRICS)


@query(
    "t3_replayed_batch",
    f"""SELECT 'hot' AS store, count(*) AS n FROM {_HOT}
        UNION ALL SELECT 'archive', count(*) FROM {_COLD}""",
)
def replayed_batch(spark, sf_dir):
    """All messages are delivered twice; both stores look as if once."""
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    topic = _topic(spark, sf_dir)
    for _ in range(2):
        stream = messages.read_files(spark, topic)
        jobs.ingest(
            stream, DualSink(hot, cold), scratch_path(spark, "checkpoint")
        ).awaitTermination()
    stores = {"hot": hot_view(spark, hot), "archive": read_mote_archive(spark, cold)}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("store"), "n")
        for name, df in stores.items()
    ]
    return counts[0].unionByName(counts[1])


# Two sources into one store: the even events as text lines at their recorded time, then
# all messages; where both have a value the message, written later, shows.
_LINES = f"""(SELECT CAST(user_id % {MOTES} + 1 AS VARCHAR) AS mote_id, ts AS _time,
    max_by(value, event_id) AS value FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2)"""


@query(
    "t3_two_sources",
    f"""SELECT * FROM {_HOT} UNION ALL
        SELECT mote_id, 'temperature', _time, value + 100 FROM {_LINES} l
        WHERE NOT EXISTS (SELECT 1 FROM {_HOT} h WHERE h.mote_id = l.mote_id
          AND h._time = l._time AND h._field = 'temperature')""",
)
def two_sources(spark, sf_dir):
    """A backfill from text, then a live ingest, into one store; then the text once more
    from its own checkpoint, which changes nothing."""
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    text, checkpoint = scratch_path(spark, "lines"), scratch_path(spark, "checkpoint")
    events = tables.table(spark, sf_dir, "events").filter("event_id % 2 = 0")
    mote, ts = (F.col("user_id") % MOTES + 1).cast("string"), F.col("ts")
    latest = events.groupBy(mote.alias("mote"), "ts").agg(F.max_by("value", "event_id").alias("value"))
    line = F.concat_ws(
        " ", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("1"), "mote",
        (F.col("value") + 100).cast("string"), F.lit("?"), F.lit("?"), F.lit("?"), times.iso_text(ts),
    )
    latest.select(line.alias("line")).write.text(text)
    sink = DualSink(hot, cold)
    jobs.backfill(spark, text, sink, checkpoint, files_per_batch=2).awaitTermination()
    jobs.ingest(
        _stream(spark, sf_dir), sink, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    jobs.backfill(spark, text, sink, checkpoint, files_per_batch=2).awaitTermination()
    return hot_view(spark, hot).select("mote_id", "_field", "_time", "_value")


@query(
    "t4_stream_dedup",
    f"SELECT DISTINCT mote_id, event_time FROM {_ACCEPTED}",
)
def stream_dedup(spark, sf_dir):
    """Several batches of files, rows of any age, and repeats across batches."""
    path, checkpoint = scratch_path(spark, "rows"), scratch_path(spark, "checkpoint")
    topic = scratch_path(spark, "topic")
    for part in range(3):
        sent = _sent(spark, sf_dir).filter(F.col("event_id") % 3 <= part)
        messages.write_files(sent, topic, ("key", "event_id", "copy"))
    stream = messages.read_files(spark, topic, files_per_batch=8)
    jobs.write_deduplicated(stream, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("mote_id", "event_time")


@query(
    "t5_rejected_messages",
    f"SELECT reject, count(*) AS n FROM {_PARSED} WHERE reject IS NOT NULL GROUP BY 1",
)
def rejected_messages(spark, sf_dir):
    _, _, rejects, _ = _ingested(spark, sf_dir)
    rows = spark.read.schema("value string, reject string").parquet(rejects)
    return rows.groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t7_live_minute_mean",
    f"""SELECT mote_id, _field, time_bucket(INTERVAL 1 MINUTE, _time) + INTERVAL 1 MINUTE AS _time,
        round(avg(_value), 6) AS _value FROM ("""
    + " UNION ALL ".join(
        f"""SELECT CAST(mote_id AS VARCHAR) AS mote_id, '{m}' AS _field, event_time AS _time,
            {m} AS _value FROM {_ACCEPTED} WHERE {m} IS NOT NULL"""
        for m in METRICS
    )
    + ") GROUP BY 1, 2, 3",
)
def live_minute_mean(spark, sf_dir):
    path = scratch_path(spark, "parts")
    jobs.write_minute_parts(
        _stream(spark, sf_dir), path, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    means = jobs.minute_means(spark.read.schema(jobs.PARTS_SCHEMA).parquet(path))
    return means.withColumn("_value", F.round("_value", 6))


@query(
    "t7_closed_windows",
    f"""SELECT CAST(mote_id AS VARCHAR) AS mote_id, round(avg(temperature), 6) AS _value,
        time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS _time
        FROM {_ACCEPTED} WHERE temperature IS NOT NULL GROUP BY 1, 3
        HAVING time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE <=
          (SELECT max(event_time) - INTERVAL 1 HOUR FROM {_ACCEPTED})""",
)
def closed_windows(spark, sf_dir):
    """Means of the windows that have closed, late rows included; the newest hour stays
    open."""
    path, topic = scratch_path(spark, "parts"), _topic(spark, sf_dir)
    stream = messages.read_files(spark, topic, files_per_batch=4)
    jobs.write_minute_parts(stream, path, scratch_path(spark, "checkpoint")).awaitTermination()
    newest = (
        messages.accepted(messages.parse(spark.read.text(topic))).agg(F.max("event_time")).first()[0]
    )
    parts = spark.read.schema(jobs.PARTS_SCHEMA).parquet(path)
    means = jobs.closed_means(parts.filter("_field = 'temperature'"), newest)
    return means.select("mote_id", "_time", F.round("_value", 6).alias("_value"))


@query(
    "t8_late_rows",
    f"""SELECT CAST(event_time AS DATE) AS date, count(DISTINCT (mote_id, event_time)) AS n_rows
        FROM {_ACCEPTED} WHERE event_id % 11 = 0 GROUP BY 1""",
)
def late_rows(spark, sf_dir):
    """Rows two years older than the rest are in the hot store like any other."""
    hot, _, _, _ = _ingested(spark, sf_dir)
    cutoff = F.expr("timestamp_ntz'2025-06-01 00:00:00'")
    points = read_hot(spark, hot)
    late = points.filter((F.col("_time") < cutoff) & (F.col("_field") == "voltage"))
    return late.groupBy(F.col("_time").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("t9_resumed_ingest", f"SELECT mote_id, _field, _time, _value FROM {_HOT}")
def resumed_ingest(spark, sf_dir):
    """Half of the messages, a stop, the other half, and a restart from the checkpoint."""
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    sent = _sent(spark, sf_dir)
    for half in range(2):
        part = sent.filter(F.col("event_id") % 2 == half)
        messages.write_files(part, topic, ("key", "event_id", "copy"))
        stream = messages.read_files(spark, topic)
        jobs.ingest(stream, DualSink(hot, cold), checkpoint).awaitTermination()
    return hot_view(spark, hot).drop("measurement", "date")


@query(
    "t10_skipped_payloads",
    f"SELECT count(*) AS n_rows FROM {_PARSED} WHERE event_id % 5 > 0",
)
def skipped_payloads(spark, sf_dir):
    sent = _sent(spark, sf_dir).withColumn(
        "value", F.when(F.col("event_id") % 5 > 0, F.col("value"))
    )
    return messages.parse(sent).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "f16_json_decode",
    f"""SELECT reject, mote_id, event_time, {_METRICS} FROM {_PARSED}
        WHERE reject IS NULL OR reject <> 'malformed'""",
)
def json_decode(spark, sf_dir):
    parsed = messages.parse(_sent(spark, sf_dir)).filter(
        F.col("reject").isNull() | (F.col("reject") != "malformed")
    )
    return parsed.select("reject", "mote_id", "event_time", *METRICS)


@query(
    "j5_repaired_archive",
    f"""SELECT CAST(mote_id AS INTEGER) AS mote_id, _time AS updated_timestamp, {_WIDE}
        FROM {_HOT} GROUP BY 1, 2""",
)
def repaired_archive(spark, sf_dir):
    """The archive after repair from the hot store, when it had lost every other day."""
    path = scratch_path(spark, "archive")
    hot = _hot_batch(spark, sf_dir)
    odd_days = hot.filter(F.dayofmonth("_time") % 2 == 1)
    repair_archive(spark, odd_days, path)
    repair_archive(spark, hot, path)
    rows = read_mote_archive(spark, path)
    return rows.select("mote_id", "updated_timestamp", *METRICS)


def _hot_batch(spark, sf_dir):
    arrival = F.col("event_id") * 2 + F.col("copy")
    parsed = messages.parse(_sent(spark, sf_dir).withColumn("arrival", arrival))
    points = to_points(messages.accepted(parsed), "event_time", keep=("arrival",))
    return last_per_point(points, "arrival")


_FOLDED_T = _T.replace("FROM lines", "FROM folded_lines")


def _line_sql(column):
    return f"CASE WHEN len(t) = 4 THEN t[4] WHEN len(t) = 9 THEN t[9] END AS {column}"


_NUMBERS = ", ".join(f"{sql_number(f't[{5 + i}]', ('?',))} AS {m}" for i, m in enumerate(METRICS))
_BAD = " OR ".join(
    f"(t[{i}] <> '?' AND lower(t[{i}]) <> 'nan' AND ({sql_number(f't[{i}]')}) IS NULL)"
    for i in range(5, 9)
)
_LOADED = f"""(SELECT mote, {sql_iso('upd')} AS at_, {_METRICS} FROM (SELECT t, {_line_sql('upd')},
    CASE WHEN len(t) = 4 THEN
        CASE WHEN regexp_matches(t[3], '^[+-]?\\d+$') THEN TRY_CAST(t[3] AS INTEGER) END
      WHEN len(t) = 9 THEN TRY_CAST(trunc({sql_number('t[4]')}) AS INTEGER) END AS mote,
    {_NUMBERS} FROM {_FOLDED_T} WHERE len(t) = 4 OR (len(t) = 9 AND NOT ({_BAD})))
    WHERE mote IS NOT NULL)"""
_N_POINTS = " + ".join(f"count({m}) FILTER (at_ IS NOT NULL)" for m in METRICS)
_ANY = f"(coalesce({_METRICS}) IS NOT NULL)"


@query(
    "s14_backfill_dry_run",
    sql(
        f"""SELECT (SELECT count(*) FROM folded_lines) AS n_lines,
            count(*) FILTER (at_ IS NOT NULL AND {_ANY}) AS n_hot_rows, {_N_POINTS} AS n_points,
            count(at_) AS n_archive_rows,
            (SELECT count(*) FROM folded_lines) - count(*) FILTER (at_ IS NOT NULL AND {_ANY}) AS n_skipped
            FROM {_LOADED}""",
        "folded_lines",
    ),
)
def backfill_dry_run(spark, sf_dir):
    lines = tables.lines(spark, sf_dir, MOTES).withColumnRenamed("event_id", "arrival")
    return jobs.backfill_report(jobs.text_messages(lines))


@query(
    "s14_backfill",
    sql(
        f"""SELECT 'hot' AS store, {_N_POINTS} AS n FROM {_LOADED}
            UNION ALL SELECT 'archive', count(DISTINCT (mote, at_)) FILTER (at_ IS NOT NULL)
            FROM {_LOADED}""",
        "folded_lines",
    ),
)
def backfill(spark, sf_dir):
    """Text to both stores, then a second run from the same checkpoint with no new file."""
    path, checkpoint = scratch_path(spark, "lines"), scratch_path(spark, "checkpoint")
    tables.lines(spark, sf_dir, MOTES).select("line").write.text(path)
    hot, cold = scratch_path(spark, "hot"), scratch_path(spark, "archive")
    sink = DualSink(hot, cold)
    for _ in range(2):
        jobs.backfill(spark, path, sink, checkpoint).awaitTermination()
    stores = {"hot": read_hot(spark, hot), "archive": read_mote_archive(spark, cold)}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("store"), "n")
        for name, df in stores.items()
    ]
    return counts[0].unionByName(counts[1])


_N_BATCHES = 6


@query(
    "s14_resumed_inside_file",
    sql(
        f"""SELECT 'hot' AS store, {_N_POINTS} AS n FROM {_LOADED}
            UNION ALL SELECT 'archive', count(DISTINCT (mote, at_)) FILTER (at_ IS NOT NULL)
            FROM {_LOADED}
            UNION ALL SELECT 'lines', count(*) FROM folded_lines
            UNION ALL SELECT 'batches', CAST(ceil(count(*) / (count(*) // {_N_BATCHES} + 1)) AS BIGINT)
            FROM folded_lines""",
        "folded_lines",
    ),
)
def resumed_inside_file(spark, sf_dir):
    """Text to both stores in batches of lines that end inside files. The load breaks off
    after its third batch is written and before it is noted, and goes on from there."""
    path, checkpoint = scratch_path(spark, "lines"), scratch_path(spark, "checkpoint")
    hot, cold, reports = (scratch_path(spark, n) for n in ("hot", "archive", "reports"))
    tables.lines(spark, sf_dir, MOTES).select("line").write.text(path)
    lines_per_batch = spark.read.text(path).count() // _N_BATCHES + 1
    sink = DualSink(hot, cold, reports=reports)

    def breaks_off(rows, batch, source):
        sink(rows, batch, source)
        if batch == 2:
            raise InterruptedError("the load is broken off")

    try:
        jobs.backfill_lines(spark, path, breaks_off, checkpoint, lines_per_batch)
    except StreamingQueryException as error:
        if "broken off" not in str(error):
            raise
    jobs.backfill_lines(spark, path, sink, checkpoint, lines_per_batch)
    loaded = spark.read.schema(REPORT).parquet(reports)
    count = F.count(F.lit(1))
    counts = {
        "hot": read_hot(spark, hot).agg(count.alias("n")),
        "archive": read_mote_archive(spark, cold).agg(count.alias("n")),
        "lines": loaded.agg(F.sum("n_read").alias("n")),
        "batches": loaded.agg(count.alias("n")),
    }
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.select(F.lit(name).alias("store"), "n") for name, df in counts.items()],
    )


@query(
    "a25_stream_latest",
    f"""SELECT mote_id, _field, max(_time) AS _time, arg_max(_value, _time) AS _value
        FROM {_HOT} GROUP BY 1, 2""",
)
def stream_latest(spark, sf_dir):
    """The table of newest values that a stream keeps up, with late and repeated messages:
    every other one comes after all the rest, and then all come once more."""
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    path = scratch_path(spark, "latest")
    sent = _sent(spark, sf_dir)
    for part in (sent.filter("event_id % 2 = 1"), sent.filter("event_id % 2 = 0"), sent):
        messages.write_files(part, topic, ("key", "event_id", "copy"))
        stream = messages.read_files(spark, topic)
        write_latest(stream, path, checkpoint).awaitTermination()
    return LatestTable(spark, path).rows().drop("measurement")
