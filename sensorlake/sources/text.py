"""Sensor text files: one reading per line, tokens separated by whitespace.

Positions of a full line: date, time, epoch, mote id, temperature, humidity, light,
voltage, remapped time. Parsers take a frame with the column ``line``, so that
they serve files, streams and derived lines alike.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import text, times
from sensorlake.schemas import LOCATION, METRICS
from sensorlake.session import written

UNKNOWN = "?"
TRAINING_NULLS = ("N/A", "nan", "")
REQUIRED_COLUMNS = ("date", "updated_timestamp", "mote_id", "temperature", "humidity")

#: File blocks whose starts go to all tasks; more are joined by shuffle.
MOST_BLOCKS = 1_000_000

_NAN = r"(?i)^[+-]?nan$"


def read_lines(spark, path):
    """Lines of one or many text files."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def numbered_lines(spark, path):
    """Lines with their position over all files, files taken in name order.

    Lines of one file block are read in order by one task, so a line's position is
    the number of lines in the blocks before plus its place in its own block. The
    blocks are a small table: one row per file split.
    """
    block = ["_file", "_block"]
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    sizes = lines.groupBy(*block).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = W.orderBy(*block).rowsBetween(W.unboundedPreceding, -1)
    starts = written(
        sizes.select(
            *block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
        ),
        "blocks",
    )
    starts = F.broadcast(starts) if starts.count() <= MOST_BLOCKS else starts
    return lines.join(starts, block).select(
        "line", (F.col("_start") + F.col("_id") - F.col("_first")).alias("position")
    )


def _token(i):
    return F.get("_t", F.lit(i))


def _metrics(first, null_marks):
    return [
        text.number(_token(first + i), null_marks).alias(m) for i, m in enumerate(METRICS)
    ]


def parse_readings(lines, keep=()):
    """Padded parse: a missing token is null and a bad number is null.

    ``mote_id`` stays a double so that the id guard can tell text from a number out
    of range; ``updated_text`` is the unparsed remapped time.
    """
    return (
        text.with_tokens(lines)
        .filter(F.size("_t") > 0)
        .select(
            *keep,
            text.number(_token(3), (UNKNOWN,)).alias("mote_id"),
            text.number(_token(2), (UNKNOWN,)).try_cast("bigint").alias("epoch"),
            times.recorded_time(_token(0), _token(1)).alias("timestamp"),
            times.iso_time(_token(8)).alias("updated_timestamp"),
            *_metrics(4, (UNKNOWN,)),
            F.when(_token(8) != UNKNOWN, _token(8)).alias("updated_text"),
        )
    )


def parse_training(lines, keep=()):
    """Nine columns for training; lines with more are skipped."""
    return (
        text.with_tokens(lines)
        .filter(F.size("_t").between(1, 9))
        .select(
            *keep,
            text.truncated_id(text.number(_token(3), TRAINING_NULLS)).alias("mote_id"),
            text.number(_token(2), TRAINING_NULLS).try_cast("bigint").alias("epoch"),
            times.recorded_time(_token(0), _token(1)).alias("timestamp"),
            times.iso_time(_token(8)).alias("updated_timestamp"),
            *_metrics(4, TRAINING_NULLS),
        )
    )


def parse_ragged(lines, keep=(), extra_tokens=False):
    """Parse by token count: 4 is a line without metrics, 9 a full one, else rejected.

    ``extra_tokens`` also takes longer lines and ignores what follows the ninth
    token. One bad number rejects the whole line: ``reject`` names the reason and
    is null for accepted lines, whose other columns are then filled.
    """
    size = F.size("_t")
    sparse = size == 4
    full = size >= 9 if extra_tokens else size == 9
    bad = [
        (_token(i) != UNKNOWN) & ~_token(i).rlike(_NAN) & text.number(_token(i)).isNull()
        for i in range(4, 8)
    ]
    mote = F.when(sparse, text.whole_number(_token(2)).try_cast("int")).when(
        full, text.truncated_id(text.number(_token(3)))
    )
    reject = (
        F.when(~(sparse | full), F.concat(size.cast("string"), F.lit(" tokens")))
        .when(mote.isNull(), F.lit("mote id"))
        .when(full & reduce(or_, bad), F.lit("metric"))
    )
    accepted = F.col("reject").isNull()
    parsed = text.with_tokens(lines).withColumn("reject", reject).withColumn("_mote", mote)
    return parsed.select(
        *keep,
        "reject",
        F.when(accepted, F.col("_mote")).alias("mote_id"),
        F.when(accepted, F.concat_ws(" ", _token(0), _token(1))).alias("timestamp_text"),
        F.when(accepted, F.when(sparse, _token(3)).otherwise(_token(8))).alias("updated_text"),
        *[
            F.when(accepted & full, text.number(_token(4 + i), (UNKNOWN,))).alias(m)
            for i, m in enumerate(METRICS)
        ],
    )


def ragged_readings(parsed):
    """Accepted ragged lines as readings with typed times."""
    date_time = F.split("timestamp_text", " ")
    return parsed.filter(F.col("reject").isNull()).select(
        "mote_id",
        F.lit(None).cast("bigint").alias("epoch"),
        times.recorded_time(date_time[0], date_time[1]).alias("timestamp"),
        times.iso_time(F.col("updated_text")).alias("updated_timestamp"),
        *METRICS,
    )


def parse_raw(lines, keep=()):
    """Eight raw columns with ``original_ts``; longer lines and bad times are dropped."""
    return (
        text.with_tokens(lines)
        .filter(F.size("_t").between(1, 8))
        .select(
            *keep,
            _token(0).alias("date"),
            _token(1).alias("time"),
            text.number(_token(2)).try_cast("bigint").alias("epoch"),
            text.number(_token(3)).alias("moteid"),
            *_metrics(4, (UNKNOWN,)),
            times.recorded_time(_token(0), _token(1)).alias("original_ts"),
        )
        .filter(F.col("original_ts").isNotNull())
    )


def read_readings(spark, path):
    return parse_readings(read_lines(spark, path))


def read_training(spark, path):
    """All lines of the training form; ``features.seeded_sample`` takes a part of them."""
    return parse_training(read_lines(spark, path))


def read_ragged(spark, path, extra_tokens=False):
    return parse_ragged(read_lines(spark, path), extra_tokens=extra_tokens)


def read_raw(spark, path):
    return parse_raw(read_lines(spark, path))


def parse_locations(lines):
    """Mote id, x and y."""
    return (
        text.with_tokens(lines)
        .filter(F.size("_t") >= 3)
        .select(
            text.whole_number(_token(0)).try_cast("int").alias("mote_id"),
            text.number(_token(1)).alias("x"),
            text.number(_token(2)).alias("y"),
        )
        .filter(F.col("mote_id").isNotNull())
        .to(LOCATION)
    )


def read_locations(spark, path):
    return parse_locations(read_lines(spark, path))


def reading_line(null_mark=UNKNOWN):
    """A reading as one line; nulls become the mark, which keeps the columns in place."""

    def shown(column):
        return F.coalesce(column.cast("string"), F.lit(null_mark))

    return F.concat_ws(
        " ",
        F.date_format("timestamp", "yyyy-MM-dd"),
        F.date_format("timestamp", "HH:mm:ss.SSSSSS"),
        shown(F.col("epoch")),
        shown(F.col("mote_id")),
        *[shown(F.col(m)) for m in METRICS],
        F.coalesce(times.iso_text(F.col("updated_timestamp")), F.lit(null_mark)),
    )


def write_readings(df, path):
    """Readings as text without header; row order is kept per partition."""
    df.select(reading_line().alias("value")).write.text(path)


def read_csv(spark, path, required=REQUIRED_COLUMNS):
    """CSV with a header as text columns; missing required columns raise."""
    df = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def csv_readings(df):
    """Typed columns of a CSV that passed the column check."""
    return df.select(
        F.col("mote_id"),
        F.col("date"),
        times.iso_time(F.col("updated_timestamp")).alias("updated_timestamp"),
        *[text.number(F.col(m)).alias(m) for m in METRICS if m in df.columns],
    )


def read_dates(spark, path):
    """Recorded dates of a file that is either CSV with a header or plain tokens.

    The first line decides, as only a header holds commas. In CSV the column
    ``date`` holds date and time.
    """
    lines = read_lines(spark, path)
    head = lines.first()
    if head is not None and "," in head["line"]:
        source = spark.read.option("header", True).csv(path)
        pieces = F.split(F.trim(F.col("date")), " ")
        moment = times.recorded_time(F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1)))
        return source.select(moment.cast("date").alias("date")).dropna()
    return (
        text.with_tokens(lines)
        .select(times.recorded_time(_token(0), _token(1)).cast("date").alias("date"))
        .dropna()
    )
