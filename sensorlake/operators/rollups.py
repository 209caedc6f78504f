"""Sums of time: per mote, field and minute, hour or day the number of points, their total,
least and most. Parts of one unit merge, so hours come from minutes and days from hours, and
parts of several loads add up.

A question over a time range is answered from whole days, the whole hours around them, the
whole minutes around those, and the points of the two edges, which are less than a minute
each. So it reads at most some 60 minutes, 23 hours and the days per series, twice at the
edges, however many points there are.

The points must be one per mote, field and time, as ``sinks.hot_view`` shows them. Points
without a value do not count, and windows with only such points are absent.
"""

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.timeseries import check_metric, select_points
from sensorlake.schemas import MEASUREMENT, METRICS

UNITS = {"day": timedelta(days=1), "hour": timedelta(hours=1), "minute": timedelta(minutes=1)}
SCHEMA = (
    "mote_id string, _field string, start timestamp_ntz, n long, total double, least double, "
    "most double, unit string, date date"
)
_EPOCH = datetime(1970, 1, 1)
_PARTS = {"n": F.sum, "total": F.sum, "least": F.min, "most": F.max}


def _merged(parts, *keys):
    return parts.groupBy(*keys).agg(*[merge(c).alias(c) for c, merge in _PARTS.items()])


def _of_points(points):
    """Points as parts of one point each."""
    value = F.col("_value")
    found = points.filter(value.isNotNull())
    parts = (F.lit(1).cast("long"), value, value, value)
    return found.select("mote_id", "_field", "_time", *[p.alias(c) for p, c in zip(parts, _PARTS)])


def _by(parts, time, unit):
    start = F.window(time, f"1 {unit}")["start"]
    return _merged(parts.withColumn("start", start), "mote_id", "_field", "start")


def write(points, path, measurement=MEASUREMENT, mode="append"):
    """Adds the points to the rollups at ``path``: a folder per unit and date. Hours and
    days are made of the written minutes and hours, so the points are read once."""
    spark = points.sparkSession
    rows, time = _of_points(points.filter(F.col("measurement") == measurement)), "_time"
    load = datetime.now().strftime("%Y%m%d%H%M%S%f")
    for unit in reversed(UNITS):
        target = f"{path}/unit={unit}/load={load}"
        dated = _by(rows, time, unit).withColumn("date", F.col("start").cast("date"))
        dated.hint("rebalance", F.col("date")).write.mode(mode).partitionBy("date").parquet(target)
        rows = spark.read.schema(SCHEMA).parquet(target).drop("unit", "date")
        time = "start"


def read(spark, path):
    """All parts; those of one series, unit and start from several loads are not merged yet."""
    return spark.read.schema(SCHEMA).parquet(path)


def pieces(start, stop, units=tuple(UNITS)):
    """(unit, from, to) pieces of a time range, the largest whole units first; ``raw`` is
    what holds no whole unit."""
    if start >= stop:
        return []
    if not units:
        return [("raw", start, stop)]
    size = UNITS[units[0]]
    first = _EPOCH + -(-(start - _EPOCH) // size) * size
    last = _EPOCH + (stop - _EPOCH) // size * size
    if first >= last:
        return pieces(start, stop, units[1:])
    return [
        *pieces(start, first, units[1:]), (units[0], first, last), *pieces(last, stop, units[1:])
    ]


def in_range(parts, points, as_of, start, stop="now()", metric=None, mote_id=None, units=tuple(UNITS)):
    """Parts that make up a time range: rollups of whole units, and points of the edges."""
    lo, hi = times.bound(start, as_of), times.bound(stop, as_of)
    found = pieces(lo, hi, units)
    whole = [
        (F.col("unit") == unit)
        & (F.col("start") >= times.at(a)) & (F.col("start") < times.at(b))
        & F.col("date").between(times.day(a.date()), times.day(b.date()))
        for unit, a, b in found if unit != "raw"
    ]
    edges = [
        (F.col("_time") >= times.at(a)) & (F.col("_time") < times.at(b))
        for unit, a, b in found if unit == "raw"
    ]
    parts = parts.filter(reduce(or_, whole, F.lit(False)))
    if metric is not None:
        parts = parts.filter(F.col("_field") == check_metric(metric))
    if mote_id is not None:
        parts = parts.filter(F.col("mote_id") == str(mote_id))
    edge = select_points(points, as_of, lo, hi, metric=metric, mote_id=mote_id)
    edge = _of_points(edge.filter(reduce(or_, edges, F.lit(False))))
    return parts.select("mote_id", "_field", "start", *_PARTS).unionByName(
        edge.withColumnRenamed("_time", "start")
    )


def metric_summary(parts, points, metric, as_of, start="-24h", stop="now()", mote_id=None):
    """As ``timeseries.metric_summary``."""
    found = in_range(parts, points, as_of, start, stop, metric, mote_id)
    return found.agg(
        F.lit(metric).alias("metric"),
        F.round(F.sum("total") / F.nullif(F.sum("n"), F.lit(0)), 4).alias("mean"),
        F.round(F.min("least"), 4).alias("min"),
        F.round(F.max("most"), 4).alias("max"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
    )


def mean_of_means(parts, points, metric, as_of, start="-1h"):
    """As ``timeseries.mean_of_means``."""
    found = in_range(parts, points, as_of, start, metric=metric)
    means = _merged(found, "mote_id").select((F.col("total") / F.col("n")).alias("mote_mean"))
    return means.agg(
        F.round(F.avg("mote_mean"), 2).alias("mean"), F.count("mote_mean").alias("n_motes")
    )


def minute_mean(parts, points, metric, as_of, start="-1h"):
    """As ``timeseries.minute_mean``; windows at the edges hold the points in the range."""
    found = in_range(parts, points, as_of, start, metric=metric, units=("minute",))
    window = F.window("start", "1 minute").alias("_window")
    merged = _merged(found.select("*", window), "mote_id", "_window")
    return merged.select(
        "mote_id", F.col("_window.end").alias("_time"), (F.col("total") / F.col("n")).alias("_value")
    )


def ingestion_rate(parts, points, as_of, minutes=5):
    """As ``timeseries.ingestion_rate``."""
    found = in_range(parts, points, as_of, f"-{minutes}m", metric=METRICS[0])
    total = F.coalesce(F.sum("n"), F.lit(0))
    return found.agg(
        F.round(total / F.lit(float(minutes)), 2).alias("records_per_minute"), total.alias("total")
    )
