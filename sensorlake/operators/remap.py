"""Move recorded times to today, and split data by time or position."""

from datetime import timedelta

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import text, times
from sensorlake.operators.slices import ROWS_PER_SLICE, positions, previous_time
from sensorlake.session import written
from sensorlake.sources.text import numbered_lines

_MICRO = timedelta(microseconds=1)
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def time_bounds(df, time):
    """First and last time: one row comes back to the driver."""
    row = df.agg(F.min(time), F.max(time)).first()
    return row[0], row[1]


def split_time(df, time, fraction=0.8):
    """The moment at a fraction of the time range, cut to whole microseconds; None
    without rows."""
    first, last = time_bounds(df, time)
    if first is None:
        return None
    return first + int((last - first) / _MICRO * fraction) * _MICRO


def range_split(df, time, fraction=0.8):
    """Rows up to the split moment, and rows after it."""
    at = split_time(df, time, fraction)
    if at is None:
        return df.limit(0), df.limit(0)
    return df.filter(F.col(time) <= times.at(at)), df.filter(F.col(time) > times.at(at))


def shift_last_to(df, time, moment, into="updated_timestamp"):
    """Move all times so that the last one becomes ``moment``."""
    _, last = time_bounds(df, time)
    shifted = F.col(time) if last is None else times.shift(F.col(time), moment - last)
    return df.withColumn(into, shifted)


def shift_first_to(df, time, moment, into="updated_timestamp"):
    """Move all times so that the first one becomes ``moment``."""
    first, _ = time_bounds(df, time)
    shifted = F.col(time) if first is None else times.shift(F.col(time), moment - first)
    return df.withColumn(into, shifted)


def to_present(df, time, as_of, fraction=0.8):
    """Historical rows end at ``as_of``, incremental rows start a minute later."""
    historical, incremental = range_split(df, time, fraction)
    return (
        shift_last_to(historical, time, as_of),
        shift_first_to(incremental, time, as_of + timedelta(minutes=1)),
    )


def full_timeline(historical, incremental):
    """Both parts as one table."""
    return historical.unionByName(incremental)


def _remapped_time():
    """The remapped time of a line that has one, read without its offset."""
    last = F.when(F.size("_t").isin(4, 9), F.element_at("_t", -1))
    return times.iso_time_unshifted(last)


def _with_last_token(new):
    replaced = F.regexp_replace(F.col("line"), F.lit(r"\s+\S+\s*$"), F.concat(F.lit(" "), new))
    return F.when(new.isNull(), F.col("line")).otherwise(replaced)


def last_remapped_date(lines):
    """The latest remapped date of the lines, or None."""
    return text.with_tokens(lines).agg(F.max(_remapped_time()).cast("date")).first()[0]


def remap_historical_lines(lines, as_of):
    """Shift remapped times by whole days so that the last date is yesterday.

    Only the last token changes; a line without a readable remapped time stays.
    """
    last = last_remapped_date(lines)
    if last is None:
        return lines.withColumn("changed", F.lit(False))
    days = (as_of.date() - timedelta(days=1) - last).days
    new = times.iso_text(times.shift_days(_remapped_time(), days))
    return (
        text.with_tokens(lines)
        .withColumn("_new", new)
        .withColumn("line", _with_last_token(F.col("_new")))
        .withColumn("changed", F.col("_new").isNotNull())
        .drop("_t", "_new")
    )


def date_map(lines, as_of):
    """Recorded dates in order, mapped to today, tomorrow and so on.

    The table has one row per calendar date, so its ordered window and its
    broadcast below stay small whatever the number of lines.
    """
    first = F.get("_t", F.lit(0))
    date = F.when(first.rlike(_ISO_DATE), first).try_cast("date")
    dates = (
        text.with_tokens(lines)
        .filter(F.size("_t") >= 4)
        .select(date.alias("orig_date"))
        .dropna()
        .distinct()
    )
    rank = F.dense_rank().over(W.orderBy("orig_date")) - 1
    return dates.select(
        "orig_date", F.date_add(times.day(as_of.date()), rank).alias("new_date")
    )


#: Dates that go to all tasks; a longer map is joined by shuffle.
MOST_DATES = 100_000


def _broadcast(dates):
    dates = written(dates, "dates")
    return F.broadcast(dates) if dates.count() <= MOST_DATES else dates


def remap_incremental_lines(lines, as_of):
    """Move each recorded date to its own day from today on, keeping the time of day."""
    first = F.get("_t", F.lit(0))
    date = F.when(first.rlike(_ISO_DATE), first).try_cast("date")
    new = times.iso_text(times.with_date(_remapped_time(), F.col("new_date")))
    return (
        text.with_tokens(lines)
        .withColumn("orig_date", date)
        .join(_broadcast(date_map(lines, as_of)), "orig_date", "left")
        .withColumn("_new", new)
        .withColumn("line", _with_last_token(F.col("_new")))
        .withColumn("changed", F.col("_new").isNotNull())
        .drop("_t", "_new", "orig_date", "new_date")
    )


def mapping_preview(dates, as_of, fraction=0.8):
    """Where each recorded date would go: the date at the fraction of the range is today."""
    first, last = time_bounds(dates, "date")
    if first is None:
        first = last = as_of.date()  # no rows: any anchor will do
    anchor = first + timedelta(days=int(((last - first).days + 1) * fraction))
    today = times.day(as_of.date())
    offset = F.date_diff(F.col("date"), times.day(anchor))
    label = (
        F.when(offset == 0, F.lit("today"))
        .when(offset < 0, F.concat((-offset).cast("string"), F.lit(" days ago")))
        .otherwise(F.concat(offset.cast("string"), F.lit(" days in future")))
    )
    return dates.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "date", F.date_add(today, offset).alias("new_date"), label.alias("label"), "n_rows"
    )


def mapping_outcome(preview, as_of):
    """Rows a mapping keeps, and rows it would place in the future."""
    future = F.col("new_date") > times.day(as_of.date())
    rows = F.col("n_rows")
    return preview.agg(
        F.sum(rows).alias("n_rows"),
        F.coalesce(F.sum(F.when(~future, rows)), F.lit(0)).alias("n_kept"),
        F.coalesce(F.sum(F.when(future, rows)), F.lit(0)).alias("n_future"),
    )


def with_fallback_time(readings, years):
    """Readings without a remapped time get the recorded one, some years later."""
    moved = times.shift_years(F.col("timestamp"), years)
    return readings.withColumn("updated_timestamp", F.coalesce("updated_timestamp", moved))


def position_split(df, at, order, ratio=0.8, rows_per_slice=ROWS_PER_SLICE, ties=()):
    """The first share of the rows in table order, and the rest; ``ties`` are the columns of
    the order along which a burst at one ``at`` is cut."""
    _check_ratio(ratio)
    numbered = positions(df, [], at, order, "_position", rows_per_slice, ties)
    limit = int(df.count() * ratio)
    return (
        numbered.filter(F.col("_position") < limit).drop("_position"),
        numbered.filter(F.col("_position") >= limit).drop("_position"),
    )


def _check_ratio(ratio):
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")


def split_lines(spark, path, ratio=0.8):
    """The first share of the lines of a file, and the rest, with positions."""
    _check_ratio(ratio)
    numbered = numbered_lines(spark, path)
    limit = int(spark.read.text(path).count() * ratio)
    return (
        numbered.filter(F.col("position") < limit),
        numbered.filter(F.col("position") >= limit),
    )


def replay_schedule(
    readings, speed=100.0, order=("timestamp", "epoch"), rows_per_slice=ROWS_PER_SLICE
):
    """Gap to the mote's previous reading and seconds after replay start, both in order.

    In time order no gap is negative, so the gaps before a row add up to its
    distance from the mote's first reading; no running sum is needed.
    """
    timed = readings.withColumn("_at", times.micros(F.col("timestamp")))
    lagged = previous_time(
        timed, ["mote_id"], "_at", "timestamp", order, "previous", rows_per_slice, order[1:]
    )
    first = timed.groupBy("mote_id").agg(F.min("_at").alias("_first"))
    gap = (F.col("_at") - times.micros(F.col("previous"))) / 1_000_000
    return (
        lagged.join(first, "mote_id", "left")
        .withColumn("gap_seconds", F.coalesce(gap, F.lit(0.0)))
        .withColumn("replay_seconds", (F.col("_at") - F.col("_first")) / 1_000_000 / speed)
        .drop("_at", "_first", "previous")
    )
