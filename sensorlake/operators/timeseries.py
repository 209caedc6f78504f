"""Questions to the hot store: long points, one row per series and time."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.schemas import MEASUREMENT, METRICS


def to_points(readings, time, measurement=MEASUREMENT, keep=()):
    """Readings as points, one per metric that has a value."""
    return (
        readings.select(
            F.lit(measurement).alias("measurement"),
            F.col("mote_id").cast("string").alias("mote_id"),
            *METRICS,
            F.col(time).alias("_time"),
            *keep,
        )
        .unpivot(["measurement", "mote_id", "_time", *keep], list(METRICS), "_field", "_value")
        .filter(F.col("_value").isNotNull())
        .select("measurement", "mote_id", "_field", "_value", "_time", *keep)
    )


def to_readings(points, keys=("mote_id", "_time")):
    """Points as one row per mote and time with a column per metric."""
    return points.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_field") == m, F.col("_value"))).alias(m) for m in METRICS]
    )


def check_metric(metric):
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    return metric


def select_points(
    points, as_of, start, stop="now()", metric=None, mote_id=None, measurement=MEASUREMENT
):
    """Points of a time range, optionally of one metric and one mote.

    Points with their ``date`` (the folders of the hot store) are limited by it as well.
    """
    found = points.filter(times.in_range("_time", start, as_of, stop))
    if "date" in points.columns:
        first, last = times.bound(start, as_of).date(), times.bound(stop, as_of).date()
        found = found.filter(F.col("date").between(times.day(first), times.day(last)))
    if measurement is not None:
        found = found.filter(F.col("measurement") == measurement)
    if metric is not None:
        found = found.filter(F.col("_field") == check_metric(metric))
    if mote_id is not None:
        found = found.filter(F.col("mote_id") == str(mote_id))
    return found


def metric_summary(points, metric, as_of, start="-24h", mote_id=None):
    """Mean, minimum, maximum and count of a metric; one row even without points."""
    return select_points(points, as_of, start, metric=metric, mote_id=mote_id).agg(
        F.lit(metric).alias("metric"),
        F.round(F.avg("_value"), 4).alias("mean"),
        F.round(F.min("_value"), 4).alias("min"),
        F.round(F.max("_value"), 4).alias("max"),
        F.count("_value").alias("count"),
    )


def active_motes(points, as_of, start="-15m"):
    """How many motes reported."""
    return select_points(points, as_of, start).agg(
        F.countDistinct("mote_id").alias("active_motes")
    )


def mote_list(points, as_of, start="-24h"):
    """Ids of the motes that reported, in text order."""
    return select_points(points, as_of, start).select("mote_id").distinct().orderBy("mote_id")


def ingestion_rate(points, as_of, minutes=5):
    """Readings per minute, counted by their temperature."""
    return select_points(points, as_of, f"-{minutes}m", metric="temperature").agg(
        F.round(F.count("_value") / F.lit(float(minutes)), 2).alias("records_per_minute"),
        F.count("_value").alias("total"),
    )


def mean_of_means(points, metric, as_of, start="-1h"):
    """Mean over motes of each mote's mean: every mote weighs the same."""
    per_mote = (
        select_points(points, as_of, start, metric=metric)
        .groupBy("mote_id")
        .agg(F.avg("_value").alias("mote_mean"))
    )
    return per_mote.agg(
        F.round(F.avg("mote_mean"), 2).alias("mean"), F.count("mote_mean").alias("n_motes")
    )


def record_count(points, as_of, start="-24h"):
    """Readings in the window, counted by their temperature."""
    return select_points(points, as_of, start, metric="temperature").agg(
        F.count("_value").alias("n_records")
    )


def minute_mean(points, metric, as_of, start="-1h", every="1 minute"):
    """Mean per mote and window, labelled by the window's end; empty windows are absent."""
    return (
        select_points(points, as_of, start, metric=metric)
        .groupBy("mote_id", F.window("_time", every).alias("_window"))
        .agg(F.avg("_value").alias("_value"))
        .select("mote_id", F.col("_window.end").alias("_time"), "_value")
    )


def top_motes(df, k, value=None):
    """The motes with the most rows (or non-null values); equal counts go by id."""
    counted = F.count(value) if value else F.count(F.lit(1))
    return df.groupBy("mote_id").agg(counted.alias("n")).orderBy(F.desc("n"), "mote_id").limit(k)


def of_top_motes(df, k, value=None):
    """Rows of the top motes; the k ids are broadcast."""
    return df.join(F.broadcast(top_motes(df, k, value).select("mote_id")), "mote_id", "left_semi")


def latest_values(points, as_of, start="-1h", mote_id=None):
    """Newest value and its time per mote and field."""
    return (
        select_points(points, as_of, start, mote_id=mote_id)
        .groupBy("mote_id", "_field")
        .agg(F.max_by("_value", "_time").alias("_value"), F.max("_time").alias("_time"))
    )


def latest_points(points, as_of, start="-1h", mote_id=None):
    """Newest values pivoted by time and mote: fields that last reported at different
    times stay on different rows."""
    return to_readings(latest_values(points, as_of, start, mote_id))


def latest_reading(points, as_of, start="-1h"):
    """One row per mote: the newest value of each metric and when it was last seen."""
    return wide_latest(latest_values(points, as_of, start))


def wide_latest(values):
    """Newest values of the fields of each mote on one row."""
    return values.groupBy("mote_id").agg(
        *[F.max(F.when(F.col("_field") == m, F.col("_value"))).alias(m) for m in METRICS],
        F.max("_time").alias("last_seen"),
    )


def latest_grid(points, as_of, start="-1h"):
    """Newest values for display, two decimals, by mote."""
    rows = latest_points(points, as_of, start)
    return rows.select(
        "mote_id", *[F.round(m, 2).alias(m) for m in METRICS], F.col("_time").alias("last_seen")
    ).orderBy("mote_id", "last_seen")


def history(points, mote_id, as_of, start="-1h", stop="now()", limit=500):
    """Readings of one mote in time order, 1 to 5000 of them."""
    if not 1 <= limit <= 5000:
        raise ValueError("limit must be between 1 and 5000")
    return (
        to_readings(select_points(points, as_of, start, stop, mote_id=mote_id))
        .orderBy("_time")
        .limit(limit)
    )


def first_per_series(df, n, series=("mote_id",), order=("_time",)):
    """The first n rows of each series. Map tasks keep n rows per series already, so a
    large series does not travel."""
    rank = F.row_number().over(W.partitionBy(*series).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def newest(df, n=20, time="_time", ties=("mote_id",)):
    """The n newest rows."""
    return df.orderBy(F.desc(time), *ties).limit(n)


def newest_record(df, time="_time", ties=()):
    """The newest row of the table."""
    row = F.struct(*[F.col(c) for c in df.columns])
    by = F.struct(F.col(time), *[F.col(c) for c in ties]) if ties else F.col(time)
    return df.agg(F.max_by(row, by).alias("r")).select("r.*")


def freshness(df, as_of, time="_time", limit_minutes=60):
    """Age of the newest row in minutes and whether it is below the limit."""
    age = (times.micros(times.at(as_of)) - times.micros(F.max(time))) / 60_000_000
    return df.agg(
        F.max(time).alias("newest"),
        F.round(age, 4).alias("age_minutes"),
        (age < limit_minutes).alias("fresh"),
    )


def time_span(df, time="_time"):
    """First and last time and the seconds between."""
    seconds = (times.micros(F.max(time)) - times.micros(F.min(time))) / 1_000_000
    return df.agg(
        F.min(time).alias("earliest"),
        F.max(time).alias("latest"),
        seconds.alias("span_seconds"),
    )


def point_count(points):
    """Points over all fields."""
    return points.agg(F.count(F.lit(1)).alias("n_points"))


def series_overview(points):
    """Distinct measurements, fields and motes, one row per kind and name."""
    return (
        points.select("measurement", F.col("_field").alias("field"), F.col("mote_id").alias("mote"))
        .unpivot([], ["measurement", "field", "mote"], "kind", "name")
        .distinct()
    )


def mote_count_check(df, low=42, high=44):
    """Motes with rows and whether their number is as expected."""
    motes = df.groupBy("mote_id").agg(F.count(F.lit(1)).alias("n"))
    return motes.agg(
        F.count(F.lit(1)).alias("n_motes"), F.count(F.lit(1)).between(low, high).alias("expected")
    )
