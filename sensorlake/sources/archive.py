"""The Parquet archive: folders by day (and mote), inventory, compaction."""

import uuid
from datetime import timedelta
from functools import reduce
from operator import or_

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from sensorlake.functions import times
from sensorlake.schemas import DAILY_ARCHIVE, METRICS, MOTE_ARCHIVE, PARTITIONS, READING
from sensorlake.session import written
from sensorlake.sources import rewrite
from sensorlake.sources.paths import arrow_uri

MOTE_PARTITIONS = (*PARTITIONS, "mote_id")
MOTE_FOLDER = r"(year=\d+/month=\d+/day=\d+/mote_id=\d+)/[^/]+\.parquet$"
DAY_FOLDER = r"(year=\d+/month=\d+/day=\d+)(?:/mote_id=\d+)?/[^/]+\.parquet$"


def _balanced(df, columns):
    """Rows gathered by partition folder; the optimizer splits folders that are large
    and merges small ones into one task, so file sizes follow the data."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def with_partitions(df, event="updated_timestamp"):
    return df.withColumns(times.partition_values(F.col(event)))


def write_mote_archive(df, path, mode="append"):
    """Readings by day of the remapped time and mote, snappy compressed.

    A row needs that time and a mote id to have a folder; ``unplaced`` returns the
    others.
    """
    placed = with_partitions(
        df.filter(F.col("updated_timestamp").isNotNull() & F.col("mote_id").isNotNull())
    )
    _balanced(placed, MOTE_PARTITIONS).write.mode(mode).option("compression", "snappy").partitionBy(
        *MOTE_PARTITIONS
    ).parquet(path)


def unplaced(df):
    """Rows the archive cannot place, with the reason."""
    reason = F.when(F.col("mote_id").isNull(), "no mote id").when(
        F.col("updated_timestamp").isNull(), "no remapped time"
    )
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def daily_rows(df):
    """Rows for the typed daily archive: all four metrics and a remapped time."""
    complete = df.dropna(how="any", subset=[*METRICS, "updated_timestamp", "mote_id"])
    return with_partitions(complete).select(
        F.col("mote_id").cast("int").alias("mote_id"),
        *[F.col(m).cast("float").alias(m) for m in METRICS],
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        times.iso_text(F.col("updated_timestamp")).alias("updated_timestamp"),
        *PARTITIONS,
    )


def write_daily_archive(df, path, mode="append"):
    """Typed rows in one folder per day; metrics as floats, times as text."""
    _balanced(daily_rows(df), PARTITIONS).write.mode(mode).option(
        "compression", "snappy"
    ).partitionBy(*PARTITIONS).parquet(path)


def load_preview(df):
    """What a load would write: rows and motes per day folder."""
    return (
        daily_rows(df)
        .groupBy(*PARTITIONS)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("mote_id").alias("n_motes"))
    )


def list_files(spark, path):
    """Path and size of every Parquet file below ``path``; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(F.col("path"), F.col("length").alias("bytes"))
    )


_TEXT_TIMES = StructType(
    [StructField("timestamp", StringType()) if f.name == "timestamp" else f for f in MOTE_ARCHIVE]
)


def read_mote_archive(spark, path, text_times=False):
    """The archive by day and mote; ``text_times`` reads recorded times kept as ISO text.

    A file that cannot be read is an error; ``read_tree`` sets such files aside.
    """
    rows = spark.read.schema(_TEXT_TIMES if text_times else MOTE_ARCHIVE).parquet(path)
    if text_times:
        rows = rows.withColumn("timestamp", _any_time(F.col("timestamp")))
    return rows


def _any_time(column):
    return times.iso_time(F.regexp_replace(column, " ", "T"))


def read_daily_archive(spark, path):
    """The daily archive with its text times parsed and floats widened."""
    return _daily(spark.read.schema(DAILY_ARCHIVE).parquet(path))


def _daily(rows):
    return rows.withColumns(
        {
            "timestamp": _any_time(F.col("timestamp")),
            "updated_timestamp": _any_time(F.col("updated_timestamp")),
            **{m: F.col(m).cast("double") for m in METRICS},
        }
    )


def combined_readings(*archives):
    """Archives of different layouts as one set of readings; absent columns are null."""
    names = READING.fieldNames()
    typed = [a.select(*[c for c in names if c in a.columns]) for a in archives]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in READING if f.name not in merged.columns}
    return merged.withColumns(absent).select(*names)


def file_key(column):
    """A file path without the slashes that spellings of its scheme differ in."""
    return F.regexp_replace(column, r"^(\w+):/+", r"$1:/")


def _lenient(spark, schema, path, glob):
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    return (
        reader.option("basePath", path)
        .parquet(f"{path}/{glob}")
        .withColumn("_key", file_key(F.col("_metadata.file_path")))
    )


def _whole_files(rows):
    """Keys of the files all of whose columns could be read; the hash makes it read them."""
    columns = [c for c in rows.columns if c != "_key"]
    return rows.groupBy("_key").agg(F.bit_xor(F.xxhash64(*columns)).alias("content"))


_BY_MOTE, _BY_DAY = "year=*/month=*/day=*/mote_id=*", "year=*/month=*/day=*/*.parquet"


def read_tree(spark, path):
    """Readings of an archive in which layouts and types are mixed, and its unread files.

    Each file is read in the first form that fits all of its columns: by mote, by mote
    with times as text, daily. The second table has the path of every Parquet file that
    fits none (or has no rows).
    """
    files = written(list_files(spark, path).select("path"), "tree-files")
    files = files.withColumn("_key", file_key(F.col("path")))
    forms = [
        (_BY_MOTE, MOTE_ARCHIVE, lambda rows: rows),
        (_BY_MOTE, _TEXT_TIMES, lambda rows: rows.withColumn("timestamp", _any_time(F.col("timestamp")))),
        (_BY_DAY, DAILY_ARCHIVE, _daily),
    ]
    found = []
    for glob, schema, typed in forms:
        try:
            rows = _lenient(spark, schema, path, glob)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        whole = written(_whole_files(rows).join(files, "_key", "left_semi"), "tree-files")
        found.append(typed(rows.join(whole.select("_key"), "_key", "left_semi").drop("_key")))
        files = written(files.join(whole, "_key", "left_anti"), "tree-files")
    if not found:
        found = [spark.createDataFrame([], READING)]
    return combined_readings(*found), files.select("path")


def recent_days(as_of, days):
    """Condition on the day folders for the day of ``as_of`` and the ones before."""
    dates = [as_of.date() - timedelta(days=i) for i in range(days)]
    return reduce(
        or_,
        [
            (F.col("year") == f"{d.year:04d}")
            & (F.col("month") == f"{d.month:02d}")
            & (F.col("day") == f"{d.day:02d}")
            for d in dates
        ],
    )


def has_day(archive, as_of):
    """Whether the archive holds any row of that day; only its folder is read."""
    return not archive.filter(recent_days(as_of, 1)).isEmpty()


def folder_of(column, pattern=MOTE_FOLDER):
    """The partition folder inside a file path, null for other files."""
    found = F.regexp_extract(column, pattern, 1)
    return F.when(found != "", found)


def inventory(spark, path, pattern=MOTE_FOLDER):
    """Files, bytes and folder of the archive; ``folder`` is null for foreign files."""
    return list_files(spark, path).withColumn("folder", folder_of(F.col("path"), pattern))


def inventory_report(files):
    """Files and bytes per folder."""
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")
    )


def compaction_plan(files, min_files=2, only=None, limit=0):
    """Folders with enough files to be worth one rewrite, in name order."""
    plan = inventory_report(files.filter(F.col("folder").isNotNull())).filter(
        F.col("n_files") >= min_files
    )
    if only is not None:
        plan = plan.filter(F.col("folder") == only)
    return plan.orderBy("folder").limit(limit) if limit else plan


def delete_files(files):
    """Delete exactly the files in the column ``path``; one that is gone already is fine.

    The tasks use Arrow's file systems, so names never gather on the driver.
    """

    def remove(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                system, name = fs.FileSystem.from_uri(arrow_uri(path))
                try:
                    system.delete_file(name)
                except FileNotFoundError:
                    pass
            yield batch.select(["path"])

    files.select("path").mapInArrow(remove, "path string").write.format("noop").mode(
        "overwrite"
    ).save()


def _arrow_fields():
    """The archive's own columns, as Arrow has them."""
    return list(to_arrow_schema(StructType([f for f in MOTE_ARCHIVE if f.name not in MOTE_PARTITIONS])))


def compact(spark, path, min_files=2, only=None, limit=0, dry_run=False, keep_originals=False):
    """Rewrite folders of many small files and report per folder.

    The files to replace are listed first, and tasks write their rows, with the union of
    their columns, into a hidden folder. A folder goes on only if every listed file was
    read, else it is left as it is and reported as ``partial`` (or as ``error`` if nothing
    of it could be read or its files disagree about a type). Each new file then takes the
    place of exactly the files it was written from, so files that arrive meanwhile stay. A
    second run finds nothing to do. While a task swaps a file, rows of that file show
    twice; tables of ``sources.snapshots`` have no such moment. ``keep_originals`` stops
    before the swap. One job rewrites all folders, and no name goes to the driver.
    """
    files = written(inventory(spark, path).filter(F.col("folder").isNotNull()), "files")
    plan = written(compaction_plan(files, min_files, only, limit), "compaction-plan")
    found = rewrite.bins(files, plan)
    if dry_run:
        return plan.join(rewrite.counted(found), "folder", "left").select(
            "folder",
            "n_files",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.lit("dry_run").alias("status"),
        )
    aside = f"{path}/_compaction-{uuid.uuid4().hex}"
    parts = written(rewrite.merge(found, aside, _arrow_fields()), "compaction")
    report = written(rewrite.report(plan, parts), "compaction-report")
    if not keep_originals:
        done = report.filter("status = 'ok'").select("folder")
        rewrite.swap(parts.join(done, "folder", "left_semi"), path)
    return report


def compaction_totals(report):
    """One row: folders, files and rows in, and folders per status."""
    return report.agg(
        F.count(F.lit(1)).alias("n_folders"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[
            F.count_if(F.col("status") == s).alias(f"n_{s}")
            for s in ("ok", "partial", "error", "dry_run")
        ],
    )
