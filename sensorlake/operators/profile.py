"""Profiles and quality reports over readings."""

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.slices import ROWS_PER_SLICE, exact_quantiles, positions
from sensorlake.operators.timeseries import of_top_motes
from sensorlake.schemas import METRICS, VALID_RANGES
from sensorlake.session import written

#: Approximate quantiles are off by at most one in so many of the rows.
ACCURACY = 10_000


def long_metrics(readings, keys=()):
    """One row per reading and metric, nulls included."""
    return readings.select(*keys, *METRICS).unpivot(list(keys), list(METRICS), "_field", "_value")


def between_dates(readings, first, last, time="timestamp"):
    """Rows dated from the first to the last day, both included."""
    start = F.lit(first).cast("date").cast("timestamp_ntz")
    stop = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return readings.filter((F.col(time) >= start) & (F.col(time) < stop))


def kpis(readings, time="timestamp"):
    """Rows, motes, first and last date."""
    return readings.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("mote_id").alias("n_motes"),
        F.min(time).cast("date").alias("first_date"),
        F.max(time).cast("date").alias("last_date"),
    )


def daily_average(readings, metric, time="timestamp"):
    """Mean per day; days without a value are absent."""
    return (
        readings.groupBy(F.col(time).cast("date").alias("date"))
        .agg(F.avg(metric).alias("avg_value"))
        .filter(F.col("avg_value").isNotNull())
    )


def weekday_hour(readings, metric, time="timestamp"):
    """Mean per weekday (Monday first) and hour of day, hours as columns."""
    return (
        readings.select(
            times.day_of_week(F.col(time)).alias("day_of_week"),
            times.day_name(F.col(time)).alias("day_name"),
            F.hour(time).alias("_hour"),
            metric,
        )
        .groupBy("day_of_week", "day_name")
        .pivot("_hour", list(range(24)))
        .agg(F.avg(metric))
        .withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})
        .orderBy("day_of_week")
    )


def histogram(readings, metric, bins=50):
    """Counts in equal-width bins between minimum and maximum, which falls in the last.

    A constant column has one bin. Minimum and maximum come from one aggregate that
    the query plans as a scalar.
    """
    values = readings.filter(F.col(metric).isNotNull())
    edges = values.agg(F.min(metric).alias("lo"), F.max(metric).alias("hi"))
    low, high = edges.select("lo").scalar(), edges.select("hi").scalar()
    bin_of = F.when(high == low, F.lit(1)).otherwise(
        F.least(
            F.floor((F.col(metric) - low) * bins / F.nullif(high - low, F.lit(0.0))) + 1,
            F.lit(bins),
        )
    )
    width = (high - low) / bins
    return (
        values.groupBy(bin_of.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (low + (F.col("bin") - 1) * width).alias("lower"), "n")
    )


def box_summary(readings, metric, k=8, rows_per_slice=ROWS_PER_SLICE):
    """Minimum, quartiles and maximum per mote for the k motes with most values."""
    values = readings.filter(F.col(metric).isNotNull()).select("mote_id", metric)
    quantiles = exact_quantiles(
        of_top_motes(values, k), ["mote_id"], metric, [0.0, 0.25, 0.5, 0.75, 1.0], rows_per_slice
    )
    names = ("min", "q1", "median", "q3", "max")
    return quantiles.select(
        "mote_id", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)]
    )


def null_rates(readings, limit=20.0):
    """Percent of nulls per metric, whether it is below the limit, and the motes seen."""
    rates = readings.agg(
        *[(F.avg(F.col(m).isNull().cast("int")) * 100).alias(m) for m in METRICS],
        F.countDistinct("mote_id").alias("n_motes"),
    )
    return rates.unpivot(["n_motes"], list(METRICS), "metric", "null_percent").select(
        "metric", "null_percent", (F.col("null_percent") < limit).alias("ok"), "n_motes"
    )


def date_distribution(readings, time="updated_timestamp", k=10):
    """The dates with most rows and their share of all rows in percent."""
    dates = readings.groupBy(F.col(time).cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    total = dates.agg(F.sum("n_rows").alias("t")).scalar()
    return (
        dates.select("date", "n_rows", (F.col("n_rows") * 100.0 / total).alias("percent"))
        .orderBy(F.desc("n_rows"), "date")
        .limit(k)
    )


def field_stats(readings):
    """Count, minimum, maximum and mean per metric; what is no number is left out."""
    values = long_metrics(readings).filter(F.col("_value").isNotNull())
    return values.groupBy(F.col("_field").alias("field")).agg(
        F.count("_value").alias("n"),
        F.min("_value").alias("min"),
        F.max("_value").alias("max"),
        F.avg("_value").alias("mean"),
    )


def remap_check(readings, as_of, time="updated_timestamp"):
    """Rows of today, of other days, of the future and without a readable time; passes if
    there are rows and none of the last two kinds."""
    now, today = times.at(as_of), times.day(as_of.date())
    is_today = F.col(time).cast("date") == today
    future = F.count_if(F.col(time) > now)
    errors = F.count_if(F.col(time).isNull())
    return readings.agg(
        F.count(time).alias("n_rows"),
        errors.alias("n_errors"),
        F.count_if(is_today).alias("n_today"),
        F.count_if(~is_today).alias("n_historical"),
        future.alias("n_future"),
        F.countDistinct(F.when(F.col(time).isNotNull(), F.col("mote_id"))).alias("n_motes"),
        ((future == 0) & (errors == 0) & (F.count(time) > 0)).alias("passed"),
    )


def rows_per_date(readings, time="timestamp"):
    return readings.groupBy(F.col(time).cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def out_of_range(readings, ranges=VALID_RANGES):
    """Values per metric and how many lie outside the plausible range."""
    values = long_metrics(readings).filter(F.col("_value").isNotNull())
    outside = F.lit(False)
    for m, (low, high) in ranges.items():
        outside = outside | ((F.col("_field") == m) & ~F.col("_value").between(low, high))
    return values.groupBy(F.col("_field").alias("field")).agg(
        F.count("_value").alias("n"), F.count_if(outside).alias("n_outside")
    )


def today_overview(readings, as_of, time="updated_timestamp"):
    """Rows, motes, first and last time of the day of ``as_of``."""
    start = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    day = readings.filter(times.in_range(time, start, as_of, start + times.duration("1d")))
    return day.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("mote_id").alias("n_motes"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
    )


def earliest_rows(readings, n, time="timestamp", ties=(), rows_per_slice=ROWS_PER_SLICE):
    """The first n rows in time order, in that order; ``ties`` are numbers.

    A bound on the time, from an approximate quantile with room for its error, leaves little
    more than n candidates and their equal times; if it should ever leave too few, all rows
    are numbered. They are numbered slice by slice, so no task gathers n rows of every other
    one, and what is left is sorted by ranges.
    """
    timed = readings.withColumn("_at", times.micros(F.col(time)))
    total = timed.count()
    share = n / max(total, 1) + 2 / ACCURACY
    candidates = timed
    if share < 1.0:
        bound = timed.agg(F.percentile_approx("_at", share, ACCURACY)).first()[0]
        early = written(timed.filter(F.col("_at").isNull() | (F.col("_at") <= bound)), "earliest")
        candidates = early if early.count() >= n else timed
    numbered = positions(
        candidates, [], "_at", [time, *ties], "_position", rows_per_slice, ties
    )
    first = numbered.filter(F.col("_position") < n).orderBy("_position")
    return first.select(*readings.columns)


def display_rows(readings, n=200, order=("timestamp", "mote_id")):
    """The display columns of the first n rows."""
    return readings.orderBy(*order).select("mote_id", "timestamp", *METRICS).limit(n)


def systematic_sample(
    df, at, order, first=3, every=50_000, most=10, rows_per_slice=ROWS_PER_SLICE, ties=()
):
    """The first rows, then every n-th, at most ``most`` of them, in table order; ``ties`` as
    in ``position_split``."""
    numbered = positions(df, [], at, order, "position", rows_per_slice, ties)
    chosen = (F.col("position") < first) | (F.col("position") % every == 0)
    return numbered.filter(chosen).orderBy("position").limit(most)


def share(part, whole):
    """Percent, null when the whole is 0."""
    return part * 100.0 / F.nullif(whole, F.lit(0))
