"""Lookups and comparisons between tables."""

from pyspark.sql import functions as F

from sensorlake.operators.clean import require_climate
from sensorlake.schemas import METRICS


def with_location(readings, locations):
    """Readings with the position of their mote, null where it is unknown."""
    return readings.join(locations, "mote_id", "left")


def location_of(locations, mote_id):
    """Position of one mote; no row when it is unknown."""
    return locations.filter(F.col("mote_id") == mote_id).select("x", "y")


def mote_ids(df):
    return df.select(F.col("mote_id").cast("string").alias("mote_id")).distinct()


def motes_in_both(hot, archive):
    """Ids present in both stores, as text."""
    return mote_ids(hot).intersect(mote_ids(archive))


def unseen(rows, archive, keys=("mote_id", "updated_timestamp")):
    """Rows whose key the archive does not hold; rows without a key stay."""
    return rows.join(archive.select(*keys).distinct(), list(keys), "left_anti")


def load_completeness(expected_readings, points, metrics=METRICS, passing=95.0, partial=80.0):
    """Stored points against the points the readings should have given.

    Readings count when temperature and humidity are known, each with every metric.
    """
    expected = require_climate(expected_readings).agg(
        (F.count(F.lit(1)) * len(metrics)).alias("n")
    )
    percent = F.col("stored") * 100.0 / F.nullif(F.col("expected"), F.lit(0))
    return (
        points.agg(F.count(F.lit(1)).alias("stored"))
        .withColumn("expected", expected.scalar())
        .withColumn("percent", F.coalesce(percent, F.lit(0.0)))
        .withColumn(
            "status",
            F.when(F.col("percent") >= passing, "passed")
            .when(F.col("percent") >= partial, "partial")
            .otherwise("failed"),
        )
        .select("expected", "stored", "percent", "status")
    )
