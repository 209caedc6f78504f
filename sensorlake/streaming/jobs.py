"""Streaming jobs: ingest, backfill from text, deduplication, live means."""

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.timeseries import to_points
from sensorlake.schemas import METRICS
from sensorlake.sources.lines import LINES_PER_BATCH, read_line_stream
from sensorlake.sources.text import parse_ragged
from sensorlake.streaming import messages, state
from sensorlake.streaming.sinks import batch_folder


def batch_trigger(seconds=1.0):
    """A micro-batch per interval; its size is capped at the source."""
    return {"processingTime": f"{seconds} seconds"}


UNTIL_CAUGHT_UP = {"availableNow": True}


def source_of(spark, checkpoint):
    """The id Spark keeps in a checkpoint: the same after a restart, new for a new one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def each_batch(stream, write, checkpoint, trigger):
    """Calls ``write(rows, batch, source)`` per batch. Progress is committed after it
    returns, and a restart from the same checkpoint repeats at most the open batch, under
    the same source and number."""
    source = []

    def named(rows, batch):
        if not source:
            source.append(source_of(rows.sparkSession, checkpoint))
        write(rows, batch, source[0])

    return (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest(stream, sink, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """Messages to both stores."""
    return each_batch(messages.parse(stream), sink, checkpoint, trigger)


def text_messages(lines):
    """Ragged text lines in the shape of parsed messages."""
    kept = [c for c in ("line", "arrival", "place") if c in lines.columns]
    parsed = parse_ragged(lines, keep=kept)
    event_time = times.iso_time(F.col("updated_text"))
    no_time = F.when(event_time.isNull(), "unreadable time")
    no_metric = F.when(F.coalesce(*METRICS).isNull(), "no metric")
    return parsed.select(
        F.col("line").alias("value"),
        *kept[1:],
        "mote_id",
        F.col("timestamp_text").alias("timestamp"),
        F.col("updated_text").alias("updated_timestamp"),
        F.lit(None).cast("string").alias("original_timestamp"),
        F.lit(None).cast("bigint").alias("epoch"),
        *METRICS,
        event_time.alias("event_time"),
        F.coalesce("reject", no_time, no_metric).alias("reject"),
    )


def read_text_stream(
    spark, path, files_per_batch=None, bytes_per_batch=messages.BYTES_PER_BATCH
):
    stream = messages.read_files(spark, path, files_per_batch, bytes_per_batch)
    return stream.withColumnRenamed("value", "line")


def backfill(
    spark, path, sink, checkpoint, files_per_batch=None, bytes_per_batch=messages.BYTES_PER_BATCH
):
    """Text files to both stores in batches, resumable: a file that was loaded is not read
    again. ``backfill_lines`` also goes on inside a file.

    ``DualSink(cold_only=True)`` leaves the hot store out.
    """
    lines = read_text_stream(spark, path, files_per_batch, bytes_per_batch)
    return each_batch(text_messages(lines), sink, checkpoint, UNTIL_CAUGHT_UP)


def run_until_caught_up(query):
    """Lets a query work off what there is, batch by batch, and stops it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def backfill_lines(
    spark, path, sink, checkpoint, lines_per_batch=LINES_PER_BATCH, bytes_per_batch=None
):
    """As ``backfill``, in batches of lines: a stop inside a file goes on with the next
    line. Returns when all lines are loaded."""
    state = f"{checkpoint}/lines"
    lines = read_line_stream(spark, path, state, lines_per_batch, bytes_per_batch)
    soon = {"processingTime": "0 seconds"}
    run_until_caught_up(each_batch(text_messages(lines), sink, checkpoint, soon))


def backfill_report(parsed):
    """Dry run of a backfill: lines read, loadable, points they give, lines skipped."""
    points = sum((F.col(m).isNotNull().cast("int") for m in METRICS), F.lit(0))
    ok = F.col("reject").isNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(ok).alias("n_hot_rows"),
        F.coalesce(F.sum(F.when(ok, points)), F.lit(0)).alias("n_points"),
        F.count_if(F.col("mote_id").isNotNull() & F.col("event_time").isNotNull()).alias(
            "n_archive_rows"
        ),
        F.count_if(~ok).alias("n_skipped"),
    )


def event_times(parsed):
    """Accepted rows with event time as the type watermarks need."""
    return messages.accepted(parsed).withColumn("event_time", F.col("event_time").cast("timestamp"))


def write_deduplicated(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """The first row to arrive per mote and event time, whatever its age.

    What was seen is keyed state in the checkpoint, so a batch costs what its rows cost,
    and the sink's own log keeps replays out. Rows without an event time are in the rejects.
    """
    rows = state.first_seen(messages.parse(stream))
    return state.started(stream.sparkSession, lambda: to_files(rows, path, checkpoint, trigger))


def write_order_counts(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """Messages per mote and batch, and how many came out of order."""
    counts = state.order_counts(messages.parse(stream))
    return state.started(stream.sparkSession, lambda: to_files(counts, path, checkpoint, trigger))


def live_minute_mean(parsed, metric, delay="1 hour", every="1 minute"):
    """Mean per mote and window as a stream, for a display: a window is emitted once the
    watermark has passed its end, and state is kept for windows still open.

    Rows later than ``delay`` are not in it. ``write_minute_parts`` counts them as well,
    and ``closed_means`` gives the same windows from its sums.
    """
    return (
        event_times(parsed)
        .filter(F.col(metric).isNotNull())
        .withWatermark("event_time", delay)
        .groupBy("mote_id", F.window("event_time", every).alias("_window"))
        .agg(F.avg(metric).alias("_value"))
        .select(
            F.col("mote_id").cast("string").alias("mote_id"),
            F.col("_window.end").alias("_time"),
            "_value",
        )
    )


def minute_parts(parsed, every="1 minute"):
    """Sum and count per mote, metric and window of one batch; stateless, so that late
    rows of any age count."""
    points = to_points(messages.accepted(parsed), "event_time")
    return (
        points.groupBy("mote_id", "_field", F.window("_time", every).alias("_window"))
        .agg(F.sum("_value").alias("total"), F.count("_value").alias("n"))
        .select("mote_id", "_field", F.col("_window.end").alias("_time"), "total", "n")
    )


PARTS_SCHEMA = (
    "mote_id string, _field string, _time timestamp_ntz, total double, n long, "
    "source string, batch long"
)


def write_minute_parts(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """Append each batch's window sums; a replayed batch replaces its own files."""

    def write(rows, batch, source):
        minute_parts(rows).write.mode("overwrite").parquet(batch_folder(path, source, batch))

    return each_batch(messages.parse(stream), write, checkpoint, trigger)


def minute_means(parts):
    """Means per mote, metric and window from the appended sums."""
    return parts.groupBy("mote_id", "_field", "_time").agg(
        (F.sum("total") / F.sum("n")).alias("_value")
    )


def closed_means(parts, newest, delay="1h"):
    """Means of the windows that ended ``delay`` before the newest event; rows that came
    later than that are counted too."""
    return minute_means(parts.filter(F.col("_time") <= times.at(newest - times.duration(delay))))


def to_files(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """A stream appended to Parquet; the sink's own log keeps replays out."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
