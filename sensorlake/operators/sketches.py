"""Approximate quantiles from mergeable sketches, one per mote, field and day.

The exact quantiles of ``slices`` stay the default. A sketch (KLL with ``K``) has a bounded
size however many values went in, and sketches of several loads or days merge, so quantiles
of any range of days come without reading its points. The value returned for a probability p
is one of the values, and its rank is within ``RANK_ERROR`` of p with a probability of 99 per
cent. Points without a value do not count; a group without any has no row.
"""

import uuid

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.schemas import MEASUREMENT
from sensorlake.session import written

#: Size of a sketch and the error of rank that goes with it.
K = 400
RANK_ERROR = 0.009
#: Points per sketch from which merging before the shuffle moves less than the points.
DENSE = 16
#: Points that one task sketches, if they are dealt out first.
POINTS_PER_TASK = 1_000_000
SCHEMA = (
    "mote_id string, _field string, n long, least double, most double, sketch binary, date date"
)


def write(points, path, measurement=MEASUREMENT, points_per_task=POINTS_PER_TASK):
    """Adds the points of a load to the sketches at ``path``, a folder per day.

    Where the sketches hold many points each, the points are merged before they move. Else the
    sketches would be larger than the points: these are dealt by day then, once, and sketched
    and written where they arrive. A day of more than ``points_per_task`` points is dealt to
    several tasks, and a mote and field may have a sketch from each, as from several loads.
    """
    value = F.col("_value")
    counts = value.isNotNull() & ~F.isnan(value) & F.col("_time").isNotNull()
    found = points.where((F.col("measurement") == measurement) & counts).select(
        "mote_id", "_field", "_value", "_time", F.col("_time").cast("date").alias("date")
    )
    days = written(
        found.groupBy("date").agg(
            F.count(F.lit(1)).alias("n"),
            F.approx_count_distinct(F.xxhash64("mote_id", "_field")).alias("groups"),
        ),
        "days",
    )
    n, groups = (total or 0 for total in days.agg(F.sum("n"), F.sum("groups")).first())
    merge_first = n >= DENSE * groups
    keys = ["mote_id", "_field", "date"]
    if not merge_first:
        parts = F.ceil(F.col("n") / points_per_task).alias("_parts")
        parts = F.broadcast(days.select("date", parts).where("_parts > 1"))
        part = F.pmod(F.xxhash64("mote_id", "_time"), F.coalesce("_parts", F.lit(1)))
        found = (
            found.join(parts, "date", "left")
            .select(*keys, "_value", part.alias("_part"))
            .repartition(-(-n // points_per_task), "date", "_part")
        )
    daily = found.groupBy(*keys, *([] if merge_first else ["_part"])).agg(
        F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.kll_sketch_agg_double(value, F.lit(K)).alias("sketch"),
    )
    daily = daily.hint("rebalance", F.col("date")) if merge_first else daily.drop("_part")
    daily.write.partitionBy("date").parquet(f"{path}/load={uuid.uuid4().hex}")


def read(spark, path):
    return spark.read.schema(SCHEMA).parquet(path)


def of_days(sketches, first, last):
    """Sketches of the days from ``first`` to ``last`` (dates), both included."""
    return sketches.where(F.col("date").between(times.day(first), times.day(last)))


def merged(sketches, *groups):
    """One sketch per group, with the count and the extremes."""
    return sketches.groupBy(*groups).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", F.lit(K)).alias("sketch"),
    )


def quantiles(sketches, groups, probabilities):
    """The groups and ``quantiles``, an array, as ``slices.exact_quantiles``; 0 and 1 are exact."""

    def at(p):
        if p <= 0 or p >= 1:
            return F.col("least" if p <= 0 else "most")
        return F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))

    found = merged(sketches, *groups)
    return found.select(*groups, F.array(*map(at, probabilities)).alias("quantiles"))


def box_summary(sketches, metric, k=8):
    """As ``profile.box_summary``, from sketches."""
    values = merged(sketches.where(F.col("_field") == metric), "mote_id")
    top = values.orderBy(F.desc("n"), "mote_id").limit(k)
    inner = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return top.select(
        "mote_id", F.col("least").alias("min"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(c) for c, p in inner.items()],
        F.col("most").alias("max"),
    )


def medians(sketches):
    """Median per field as a dict, as ``features.medians``; fields without values are absent."""
    rows = quantiles(sketches, ["_field"], [0.5]).collect()
    return {r["_field"]: r["quantiles"][0] for r in rows}
