"""Hot points, cold archive and rejects, written per micro-batch."""

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorlake.operators.dedup import first_per_key, last_per_point
from sensorlake.operators.joins import unseen
from sensorlake.operators.timeseries import to_points, to_readings
from sensorlake.schemas import METRICS, MOTE_ARCHIVE, PARTITIONS, POINT
from sensorlake.session import written
from sensorlake.sources.archive import (
    delete_files,
    file_key,
    list_files,
    read_mote_archive,
    with_partitions,
    write_mote_archive,
)
from sensorlake.sources.snapshots import SnapshotTable
from sensorlake.streaming import messages

logger = logging.getLogger(__name__)

HOT_SCHEMA = (
    StructType([*POINT])
    .add("written", "long")
    .add("source", "string")
    .add("batch", "long")
    .add("date", "date")
)
PENDING_SCHEMA = (
    StructType([f for f in MOTE_ARCHIVE if f.name not in PARTITIONS])
    .add("arrival", "string")
    .add("source", "string")
    .add("batch", "long")
)
#: Batches whose archive write failed wait here, below the hot store; readers skip the folder.
PENDING = "_pending"


def batch_folder(path, source, batch):
    """The folder of one batch of one source: a replay replaces it, nothing else does."""
    return f"{path}/source={source}/batch={batch}"


def write_hot(points, path, source, batch):
    """Points of one batch by date, with the time of writing."""
    dated = points.withColumns(
        {
            "date": F.col("_time").cast("date"),
            "written": F.unix_micros(F.current_timestamp()),
        }
    )
    dated.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(
        batch_folder(path, source, batch)
    )


def read_hot(spark, path):
    """All points ever written, with their source, batch and time of writing."""
    return spark.read.schema(HOT_SCHEMA).parquet(path)


def hot_view(spark, path):
    """What the hot store shows: per mote, field and time the value written last.

    Its column ``date`` reaches the folders of the store when a question limits it.
    """
    return last_per_point(read_hot(spark, path), F.struct("written", "source", "batch"))


def fold_hot(spark, path):
    """Replace the batches of a hot store by one folder with what they show.

    Batches that are written meanwhile stay as they are; only the files that were listed
    before are removed, after the fold is written.
    """
    old = written(list_files(spark, path).where(F.col("path").contains("/source=")), "hot-files")
    rows = read_hot(spark, path).withColumn("path", F.col("_metadata.file_path"))
    listed = rows.join(old.select(file_key(F.col("path")).alias("_key")),
                       file_key(F.col("path")) == F.col("_key"), "left_semi")
    order = F.struct("written", "source", "batch")
    folded = listed.groupBy("measurement", "mote_id", "_field", "_time", "date").agg(
        F.max_by("_value", order).alias("_value"), F.max("written").alias("written")
    )
    target = batch_folder(path, f"fold-{uuid.uuid4().hex}", 0)
    folded.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(target)
    delete_files(old)


def write_rejects(rows, path, source, batch):
    rows.write.mode("overwrite").parquet(batch_folder(path, source, batch))


def in_days_of(rows, day):
    """Condition: the text ``day`` of a table is one of the days of these rows.

    The days come to the driver as literals, so that only their folders are read; a
    batch has as many as it spans in the calendar.
    """
    days = [r[0] for r in rows.select(day.alias("d")).distinct().collect()]
    return day.isin(days)


def archive_new(spark, rows, path):
    """Append rows whose mote and time the archive lacks; the first of equal keys counts.

    Only the day folders of the rows are compared. An archive file that cannot be read
    is an error: its rows would look new.
    """
    first = first_per_key(rows, ["mote_id", "updated_timestamp"], ["arrival"]).drop("arrival")
    try:
        archive = read_mote_archive(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        write_mote_archive(first, path)
        return
    archive = archive.filter(in_days_of(with_partitions(rows), F.concat_ws("-", *PARTITIONS)))
    write_mote_archive(unseen(first, archive), path)


def with_arrival(rows):
    """Rows with ``arrival``, which orders them as they came.

    A broker gives its offset. Message files are ordered by modification time, path and
    block, and rows by their place in the block.
    """
    if "arrival" in rows.columns:
        return rows.drop("place")
    place = F.monotonically_increasing_id()
    if "place" in rows.columns:
        place = F.struct(F.col("place.*"), place.alias("row"))
    return rows.withColumn("arrival", place).drop("place")


class DualSink:
    """Writes each batch to the hot store and then to the archive.

    A failing hot write fails the batch, so its offsets are not committed and it is
    replayed. A failing archive write is logged, and the batch's archive rows wait below
    the hot store until ``retry_pending`` appends them. ``reports`` is a folder for one
    row per batch: what was read, written per store, skipped and failed.
    """

    def __init__(self, hot, archive, rejects=None, cold_only=False, reports=None):
        self.hot, self.archive, self.rejects = hot, archive, rejects
        self.cold_only, self.reports = cold_only, reports

    def __call__(self, parsed, batch, source):
        spark = parsed.sparkSession
        parsed = with_arrival(parsed).persist()
        try:
            if not self.cold_only:
                rows = messages.accepted(parsed)
                points = to_points(rows, "event_time", keep=("arrival",))
                write_hot(last_per_point(points, "arrival"), self.hot, source, batch)
            if self.rejects:
                write_rejects(messages.rejected(parsed), self.rejects, source, batch)
            rows = messages.to_archive_rows(parsed)
            failed = False
            try:
                if isinstance(self.archive, SnapshotTable):
                    self.archive.append_new(rows, source, batch)
                else:
                    archive_new(spark, rows, self.archive)
            except Exception:
                failed = True
                logger.exception("archive write of batch %s of %s failed", batch, source)
                if self.cold_only:
                    raise
                rows.withColumn("arrival", F.to_json(F.struct("arrival"))).write.mode(
                    "overwrite"
                ).parquet(batch_folder(f"{self.hot}/{PENDING}", source, batch))
            if self.reports:
                report = batch_report(parsed, self.cold_only, failed)
                report.write.mode("overwrite").parquet(batch_folder(self.reports, source, batch))
        finally:
            parsed.unpersist()


REPORT = (
    "n_read long, n_points long, n_archive_rows long, n_skipped long, n_failed long, "
    "source string, batch long"
)


def batch_report(parsed, cold_only=False, failed=False):
    """One row: messages read, points sent, archive rows sent (equal keys are written
    once), messages skipped, and archive rows that failed."""
    points = sum((F.col(m).isNotNull().cast("int") for m in METRICS), F.lit(0))
    ok = F.col("reject").isNull()
    kept = F.col("mote_id").isNotNull() & F.col("event_time").isNotNull()
    none = F.lit(0).cast("long")
    n_rows = F.count_if(kept)
    return parsed.agg(
        F.count(F.lit(1)).alias("n_read"),
        (none if cold_only else F.coalesce(F.sum(F.when(ok, points)), none)).alias("n_points"),
        (none if failed else n_rows).alias("n_archive_rows"),
        F.count_if(~ok).alias("n_skipped"),
        (n_rows if failed else none).alias("n_failed"),
    )


def load_report(reports):
    """Totals of a load over its batches."""
    names = ("n_read", "n_points", "n_archive_rows", "n_skipped", "n_failed")
    return reports.agg(
        F.count(F.lit(1)).alias("n_batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
    )


def retry_pending(spark, hot, archive_path):
    """Append the archive rows of batches whose archive write failed, then forget them.

    Returns how many files were waiting.
    """
    path = f"{hot}/{PENDING}"
    try:
        files = written(list_files(spark, path), "pending-files")
        rows = spark.read.schema(PENDING_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0
    n = files.count()
    if n:
        # rows of one batch keep their order: batches first, then the places inside
        order = F.struct("source", "batch", "arrival")
        archive_new(spark, rows.withColumn("arrival", order).drop("source", "batch"), archive_path)
        delete_files(files)
    return n


def repair_archive(spark, hot, archive_path):
    """Add readings the hot store holds and the archive lacks.

    The hot store knows neither epoch nor recorded time; where a batch was kept by the
    sink, ``retry_pending`` restores it in full and comes first.
    """
    rows = to_readings(hot).select(
        F.lit(None).cast("bigint").alias("epoch"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        F.col("_time").alias("updated_timestamp"),
        "temperature",
        "humidity",
        "light",
        "voltage",
        F.col("mote_id").try_cast("int").alias("mote_id"),
        F.lit(0).cast("bigint").alias("arrival"),
    )
    archive_new(spark, rows, archive_path)
