"""Keyed JSON messages: building, sending, reading and judging them."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensorlake.functions import times
from sensorlake.schemas import MESSAGE, METRICS

TOPIC = "sensor_readings"


def message_body():
    """The JSON value of a reading; nulls are left out."""
    return F.to_json(
        F.struct(
            F.col("mote_id").cast("int").alias("mote_id"),
            times.message_time_text(F.col("timestamp")).alias("timestamp"),
            times.message_time_text(F.col("updated_timestamp")).alias("updated_timestamp"),
            times.iso_text(F.col("timestamp")).alias("original_timestamp"),
            *[F.col(m).cast("double").alias(m) for m in METRICS],
            F.col("epoch").cast("bigint").alias("epoch"),
        )
    )


def to_messages(readings):
    """Readings as key and JSON value."""
    return readings.select(
        F.col("mote_id").cast("string").alias("key"), message_body().alias("value")
    )


def kafka_source_options(brokers, topic=TOPIC, per_batch=None):
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def kafka_sink_options(brokers, topic=TOPIC):
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": "all"}


def read_kafka(spark, brokers, topic=TOPIC, per_batch=None):
    """Messages of a topic as a stream, from the earliest offset on."""
    options = kafka_source_options(brokers, topic, per_batch)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(
        F.col("value").cast("string").alias("value"), F.col("offset").alias("arrival")
    )


def send_kafka(messages, brokers, topic=TOPIC):
    """Send messages; rows of one mote share a key and so keep their order."""
    messages.write.format("kafka").options(**kafka_sink_options(brokers, topic)).save()


def write_files(messages, path, order=("key",)):
    """Messages as JSON text files, one per line, in mote order within each file."""
    messages.sortWithinPartitions(*order).select("value").write.mode("append").text(path)


#: Bytes of message files per batch; a backlog is taken in several batches.
BYTES_PER_BATCH = 1 << 30


def read_files(spark, path, files_per_batch=None, bytes_per_batch=BYTES_PER_BATCH):
    """Message files as a stream; stands in for the broker where there is none.

    ``place`` tells the file and block of a line, for the order of arrival.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    elif bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_batch))
    meta = F.col("_metadata")
    place = F.struct(
        meta["file_modification_time"].alias("time"),
        meta["file_path"].alias("path"),
        meta["file_block_start"].alias("block"),
    )
    return reader.text(path).select("value", place.alias("place"))


_CORRUPT = "_corrupt"
_PARSED = StructType([*MESSAGE, StructField(_CORRUPT, StringType())])


def parse(messages):
    """Message values as columns; null values are skipped.

    A column ``arrival`` or ``place`` is kept; it orders the rows of one mote. A broker's
    offset does, because a mote's messages share a key and so a partition.

    ``reject`` says why a row cannot become points: malformed JSON, no mote, no
    metric, no time or an unreadable time. Accepted rows have ``event_time``: the
    remapped time, else the recorded one.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    body = F.from_json("value", _PARSED, options)
    kept = [c for c in ("value", "arrival", "place") if c in messages.columns]
    rows = messages.filter(F.col("value").isNotNull()).select(*kept, body.alias("m"))
    rows = rows.select(*kept, "m.*")
    whole = F.col(_CORRUPT).isNull()
    rows = rows.withColumns(
        {
            "mote_id": F.when(whole, F.col("mote_id")),
            **{m: F.when(whole & ~F.isnan(m), F.col(m)) for m in METRICS},
        }
    )
    time_text = times.event_time()
    rows = rows.withColumn("event_time", times.iso_time(time_text))
    reject = (
        F.when(F.col(_CORRUPT).isNotNull(), "malformed")
        .when(F.col("mote_id").isNull(), "no mote id")
        .when(F.coalesce(*METRICS).isNull(), "no metric")
        .when(time_text.isNull(), "no time")
        .when(F.col("event_time").isNull(), "unreadable time")
    )
    return rows.withColumn("reject", reject).drop(_CORRUPT)


def accepted(parsed):
    return parsed.filter(F.col("reject").isNull()).drop("reject", "value", "place")


def rejected(parsed):
    return parsed.filter(F.col("reject").isNotNull()).select("value", "reject")


def to_archive_rows(parsed):
    """Messages the archive takes: a mote and a readable time, metrics or not."""
    readable = F.col("mote_id").isNotNull() & F.col("event_time").isNotNull()
    return parsed.filter(readable).select(
        "epoch",
        times.iso_time(F.col("timestamp")).alias("timestamp"),
        F.col("event_time").alias("updated_timestamp"),
        *METRICS,
        "mote_id",
        *[c for c in ("arrival",) if c in parsed.columns],
    )
