"""Samples of a growing table that merge: per day the rows with the smallest hashes.

A row's hash comes from its key and the seed alone, as in ``features.seeded_sample``. The n
smallest of the whole are among the n smallest of each day, so keeping those of every day and
load lets a later question draw a sample of any range of days, of n rows or fewer, without a
pass over the table, and it is the sample that ``seeded_sample`` draws from all rows.

The key must be unique among the rows and without nulls. A day with fewer rows keeps all. Rows
without a time are in a folder of their own and take part when no days are named.
"""

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.features import draw_of

DRAW, DATE, LOAD = "_draw", "_date", "_load"


def _smallest(rows, n, key, *per):
    """The n rows with the smallest hashes per group. Map tasks keep n each already."""
    rank = F.row_number().over(W.partitionBy(*per).orderBy(DRAW, *key))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def write(rows, path, n, key, time="timestamp", seed=42):
    """Adds the sample of a load, a folder per day: n rows of a day at most."""
    drawn = rows.withColumns({DRAW: draw_of(key, seed), DATE: F.col(time).cast("date")})
    kept = _smallest(drawn, n, key, DATE)
    target = f"{path}/{LOAD}={uuid.uuid4().hex}"
    kept.hint("rebalance", F.col(DATE)).write.partitionBy(DATE).parquet(target)


def read(spark, path, schema):
    """The kept rows of all loads; ``schema`` is that of the rows that were written."""
    text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{text}, {DRAW} long, {DATE} date").parquet(path).drop(LOAD)


def sample(kept, n, key, days=None):
    """n rows of all or of some days (first and last date, both included)."""
    if days is not None:
        kept = kept.where(F.col(DATE).between(*map(times.day, days)))
    # a plain sort and limit keeps n rows a task, and merges those
    return kept.orderBy(DRAW, *key).limit(n).drop(DRAW, DATE)
