"""Exact distinct motes of any time range from bitmaps per minute, hour and day.

An id is a bit: a small whole number is its own code, any other text gets the next free code
from a dictionary, a table that only grows. A bitmap holds 32,768 codes in 4 kB, so a unit of
time is one row per block of codes that occur in it. Bitmaps of one unit merge by or, so hours
come from minutes, days from hours, and several loads add up.

A range is answered from whole days, the whole hours and minutes around them, and the points
of the two edges, which are less than a minute each. Ids are compared as text: ``7`` and ``07``
are two motes. Points without a mote or a time do not count; repeated points count once.
"""

import uuid
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.rollups import UNITS, pieces
from sensorlake.operators.slices import positions
from sensorlake.operators.timeseries import select_points
from sensorlake.schemas import MEASUREMENT
from sensorlake.session import written

#: Codes below this are the numbers themselves, those above come from the dictionary.
NUMBERS = 1 << 20
SCHEMA = "start timestamp_ntz, block long, bits binary, unit string, date date"
_CODES = "mote_id string, code long"


def _number(mote_id):
    """The id as a code, null if it is no small number in its usual spelling."""
    spelled = F.rlike(mote_id, F.lit(r"^(0|[1-9][0-9]{0,6})$"))
    number = F.when(spelled, mote_id.cast("long"))
    return F.when(number < NUMBERS, number)


def _bits(coded, *keys):
    """Codes as bitmaps per key and block."""
    block = F.bitmap_bucket_number("code").alias("block")
    position = F.bitmap_bit_position("code").alias("position")
    found = coded.select(*keys, block, position)
    return found.groupBy(*keys, "block").agg(F.bitmap_construct_agg("position").alias("bits"))


class DistinctMotes:
    """Bitmaps and their dictionary at ``path``; one writer at a time."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path.rstrip("/")

    def _known(self):
        try:
            return self.spark.read.schema(_CODES).parquet(f"{self.path}/codes")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _CODES)

    def _learn(self, ids):
        """Adds codes for the ids in a written table that have none."""
        known = self._known()
        new = ids.where(_number(F.col("mote_id")).isNull()).join(known, "mote_id", "left_anti")
        first = F.coalesce(F.max("code") + 1, F.lit(NUMBERS).cast("long"))
        numbered = positions(written(new, "ids"), [], "mote_id", ["mote_id"], "place")
        start = known.agg(first).first()[0]
        codes = numbered.select("mote_id", (F.col("place") + start).alias("code"))
        codes.write.mode("append").parquet(f"{self.path}/codes")

    def _coded(self, points):
        """Points with the codes of their motes; motes without one are not in the bitmaps."""
        number = _number(F.col("mote_id"))
        plain = points.where(number.isNotNull()).withColumn("code", number)
        named = points.where(number.isNull()).join(self._known(), "mote_id")
        return plain.unionByName(named)

    def add(self, points, measurement=MEASUREMENT):
        """Adds the points of a load, which are read once. A load that broke off can be
        repeated as it is: bits that are there already change nothing."""
        start = F.window("_time", "1 minute")["start"].alias("start")
        seen = points.where(
            (F.col("measurement") == measurement)
            & F.col("mote_id").isNotNull() & F.col("_time").isNotNull()
        ).select("mote_id", start).distinct()
        seen = written(seen, "seen")
        self._learn(seen.select("mote_id").distinct())
        load = uuid.uuid4().hex
        bitmaps = _bits(self._coded(seen), "start")
        for unit in reversed(UNITS):
            if unit != "minute":
                wider = F.window("start", f"1 {unit}")["start"]
                bitmaps = bitmaps.withColumn("start", wider)
                bitmaps = bitmaps.groupBy("start", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
            target = f"{self.path}/bitmaps/unit={unit}/load={load}"
            dated = bitmaps.withColumn("date", F.col("start").cast("date"))
            dated.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(target)
            bitmaps = self.spark.read.schema(SCHEMA).parquet(target).drop("unit", "date")

    def read(self):
        """All bitmaps; those of one unit and start from several loads are not merged yet."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/bitmaps")

    def in_range(self, points, as_of, start, stop="now()"):
        """Bitmaps that make up a time range, a row per block of codes."""
        found = pieces(times.bound(start, as_of), times.bound(stop, as_of))
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
        bitmaps = self.read().where(reduce(or_, whole, F.lit(False))).select("block", "bits")
        if edges:
            edge = select_points(points, as_of, start, stop).where(reduce(or_, edges))
            edge = edge.where("mote_id is not null").select("mote_id").distinct()
            bitmaps = bitmaps.unionByName(_bits(self._coded(edge)))
        return bitmaps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    # Questions

    def count(self, points, as_of, start, stop="now()"):
        """How many motes reported in a range."""
        found = self.in_range(points, as_of, start, stop)
        return found.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_motes"))

    def active_motes(self, points, as_of, start="-15m"):
        """As ``timeseries.active_motes``."""
        return self.count(points, as_of, start).withColumnRenamed("n_motes", "active_motes")

    def mote_count_check(self, points, as_of, start="-24h", low=42, high=44):
        """As ``timeseries.mote_count_check`` of the points in a range that have a mote."""
        n = F.col("n_motes")
        return self.count(points, as_of, start).select("n_motes", n.between(low, high).alias("expected"))

    def per_day(self):
        """Motes of each day."""
        days = self.read().where("unit = 'day'").groupBy("date", "block")
        merged = days.agg(F.bitmap_or_agg("bits").alias("bits")).groupBy("date")
        return merged.agg(F.sum(F.bitmap_count("bits")).alias("n_motes"))
