"""Which row of a key counts, and content keys."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df, keys, arrival):
    """The first row to arrive per key; rows whose event time is null all stay.

    The last key is the event time. Each map task already drops all but its own
    first row of a key, so many copies of one row do not travel.
    """
    time = keys[-1]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*arrival))
    keyed = df.filter(F.col(time).isNotNull()).withColumn("_rank", rank)
    keyless = df.filter(F.col(time).isNull())
    return keyed.filter(F.col("_rank") == 1).drop("_rank").unionByName(keyless)


def last_per_point(points, arrival):
    """The value written last per mote, field and time: what the hot store shows.

    A column ``date``, the day of the time, stays, so that filters on it reach the scan.
    """
    keys = ["measurement", "mote_id", "_field", "_time"]
    return points.groupBy(*keys, *[c for c in ("date",) if c in points.columns]).agg(
        F.max_by("_value", arrival).alias("_value")
    )


def batch_keys(df, time="updated_timestamp"):
    """Per day and mote: time range, rows and a short content key of the batch."""
    stamp = "yyyyMMdd_HHmmss"
    grouped = df.groupBy(F.col(time).cast("date").alias("date"), "mote_id").agg(
        F.date_format(F.min(time), stamp).alias("first"),
        F.date_format(F.max(time), stamp).alias("last"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    content = F.concat_ws(
        "_", "first", "last", F.col("n_rows").cast("string"), F.col("mote_id").cast("string")
    )
    return grouped.withColumn("batch_key", F.substring(F.sha2(content, 256), 1, 8))
