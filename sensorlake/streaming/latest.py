"""A table of the newest value per mote and field, kept up by the stream.

A batch is reduced to one row per series before it is written, and commits once: a repeated
batch changes nothing. Of the rows of a series the one with the latest event time counts,
whatever the order of arrival; of equal times the one written last, as in the hot store. Every
``FOLD_EVERY`` commits the table is rewritten with one row per series, so a question reads
what the series are and not what the points are.

Rows are in buckets by mote: a question for one mote reads its bucket only. Points without
mote, field or time belong to no series and do not count; those without a value do, as in
``timeseries.latest_values``. An empty batch adds nothing.

The table answers for the present: a series whose newest point is at or after ``as_of`` has
no value before it here, is absent from the answers, and is listed by ``ahead``.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sensorlake.functions import times
from sensorlake.operators.timeseries import select_points, to_points, to_readings, wide_latest
from sensorlake.schemas import POINT
from sensorlake.session import written
from sensorlake.sources.snapshots import Conflict, SnapshotTable
from sensorlake.streaming import messages
from sensorlake.streaming.jobs import UNTIL_CAUGHT_UP, each_batch
from sensorlake.streaming.sinks import with_arrival

SERIES = ("measurement", "mote_id", "_field")
BUCKETS = 64
FOLD_EVERY = 16
SCHEMA = StructType(
    [*POINT, StructField("written", LongType()), StructField("bucket", IntegerType())]
)


def _bucket(mote_id):
    return F.pmod(F.xxhash64(mote_id), F.lit(BUCKETS)).cast("int")


def newest(points, *order):
    """The newest point per series; ``order`` decides between equal times."""
    last = F.max_by(F.struct("_value", "_time"), F.struct("_time", *order))
    known = F.col("_time").isNotNull()
    for key in SERIES:
        known &= F.col(key).isNotNull()
    found = points.filter(known).groupBy(*SERIES).agg(last.alias("last"))
    return found.select(*SERIES, "last.*")


class LatestTable:
    """The newest values at ``path``."""

    def __init__(self, spark, path):
        self.table = SnapshotTable(spark, path, SCHEMA, ("bucket",))

    def upsert(self, points, source=None, batch=None, arrival=()):
        """Merges the points of a batch; ``arrival`` orders those of equal times. Returns
        the version."""
        now = F.unix_micros(F.current_timestamp()).alias("written")
        rows = newest(points, *arrival).select(*POINT.names, now)
        version = self.table.append(rows.withColumn("bucket", _bucket("mote_id")), source, batch)
        if version and version % FOLD_EVERY == 0:
            self.fold()
        return version

    def rows(self, mote_id=None, version=None):
        """The newest point per series, of all motes or of one."""
        files = self.table.files(version)
        if mote_id is not None:
            folder = F.concat(F.lit("bucket="), _bucket(F.lit(str(mote_id))).cast("string"))
            files = files.where(F.col("folder") == folder)
        found = self.table.read(files=files)
        if mote_id is not None:
            found = found.where(F.col("mote_id") == str(mote_id))
        return newest(found, "written")

    def fold(self):
        """One row per series in place of those of all batches so far. A fold that meets
        another one leaves the work to it."""
        files = written(self.table.files(), "latest-files")
        last = F.max_by(F.struct("_value", "_time", "written"), F.struct("_time", "written"))
        rows = self.table.read(files=files).groupBy(*SERIES, "bucket").agg(last.alias("last"))
        try:
            self.table.replace(files, rows.select(*SERIES, "last.*", "bucket"))
        except Conflict:
            pass

    # Questions

    def values(self, as_of, start="-1h", mote_id=None):
        """As ``timeseries.latest_values``."""
        found = select_points(self.rows(mote_id), as_of, start)
        return found.select("mote_id", "_field", "_value", "_time")

    def points(self, as_of, start="-1h", mote_id=None):
        """As ``timeseries.latest_points``."""
        return to_readings(self.values(as_of, start, mote_id))

    def reading(self, as_of, start="-1h"):
        """As ``timeseries.latest_reading``."""
        return wide_latest(self.values(as_of, start))

    def newest_record(self):
        """The newest point of all; of equal times the largest mote and field as text."""
        row = F.struct(*POINT.names)
        by = F.struct("_time", "mote_id", "_field")
        return self.rows().agg(F.max_by(row, by).alias("r")).select("r.*")

    def ahead(self, as_of):
        """Series whose newest point is at or after ``as_of``."""
        return self.rows().where(F.col("_time") >= times.at(as_of))


def write_latest(stream, path, checkpoint, trigger=UNTIL_CAUGHT_UP):
    """Keeps the table up with a stream of messages."""

    def write(rows, batch, source):
        arrived = messages.accepted(with_arrival(rows))
        points = to_points(arrived, "event_time", keep=("arrival",))
        LatestTable(rows.sparkSession, path).upsert(points, source, batch, ("arrival",))

    return each_batch(messages.parse(stream), write, checkpoint, trigger)
