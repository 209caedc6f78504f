"""Queries of the archive: sinks, readers, inventory, compaction, reconciliation."""

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorlake.operators import dedup, joins
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import MOTES, sql
from sensorlake.schemas import METRICS, MOTE_ARCHIVE, READING
from sensorlake.session import scratch_path, written
from sensorlake.sources import archive
from sensorlake.sources.snapshots import SnapshotTable

_METRICS = ", ".join(METRICS)
_PARTS = """strftime(updated_timestamp, '%Y') AS year, strftime(updated_timestamp, '%m') AS month,
    strftime(updated_timestamp, '%d') AS day"""
_FOLDER = """'year=' || strftime(updated_timestamp, '%Y/month=%m/day=%d') || '/mote_id=' || mote_id"""


def _folded(spark, sf_dir):
    return tables.sparse(spark, sf_dir, MOTES)


def _written(spark, sf_dir, parts=1):
    """The folded readings as an archive; several parts leave several files per folder."""
    path = scratch_path(spark, "archive")
    rows = _folded(spark, sf_dir)
    for i in range(parts):
        archive.write_mote_archive(rows.filter(F.col("epoch") % parts == i), path)
    return path


@query(
    "s11_mote_archive",
    sql(
        f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS}, {_PARTS} FROM folded""",
        "folded",
    ),
)
def mote_archive(spark, sf_dir):
    return archive.read_mote_archive(spark, _written(spark, sf_dir))


_FLOATS = ", ".join(f"CAST(CAST({m} AS FLOAT) AS DOUBLE) AS {m}" for m in METRICS)


def _complete(spark, sf_dir):
    return tables.complete(spark, sf_dir)


_COMPLETE = f"({tables.SQL_COMPLETE})"
_FOUR = " AND ".join(f"{m} IS NOT NULL" for m in METRICS)


def _read_daily(spark, sf_dir):
    path = scratch_path(spark, "daily")
    archive.write_daily_archive(_complete(spark, sf_dir), path)
    return archive.read_daily_archive(spark, path)


@query(
    "s12_daily_archive",
    f"""SELECT mote_id, "timestamp", updated_timestamp, {_FLOATS}, {_PARTS}
        FROM {_COMPLETE} WHERE {_FOUR}""",
)
def daily_archive(spark, sf_dir):
    return _read_daily(spark, sf_dir)


@query(
    "s6_archive_reader",
    f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS} FROM {_COMPLETE}
        UNION ALL SELECT mote_id, NULL, "timestamp", updated_timestamp, {_FLOATS}
        FROM {_COMPLETE} WHERE {_FOUR}""",
)
def archive_reader(spark, sf_dir):
    by_mote = scratch_path(spark, "archive")
    archive.write_mote_archive(_complete(spark, sf_dir), by_mote)
    return archive.combined_readings(
        archive.read_mote_archive(spark, by_mote), _read_daily(spark, sf_dir)
    )


@query(
    "s6_mixed_tree",
    f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS} FROM {_COMPLETE}
        WHERE epoch % 3 < 2 UNION ALL
        SELECT mote_id, NULL, "timestamp", updated_timestamp, {_FLOATS}
        FROM {_COMPLETE} WHERE epoch % 3 = 2 AND {_FOUR}""",
)
def mixed_tree(spark, sf_dir):
    """One tree of all layouts: by mote, by mote with times as text, daily."""
    path, rows = scratch_path(spark, "archive"), _complete(spark, sf_dir)
    archive.write_mote_archive(rows.filter("epoch % 3 = 0"), path)
    text = rows.filter("epoch % 3 = 1").withColumn("timestamp", F.col("timestamp").cast("string"))
    archive.write_mote_archive(text, path)
    archive.write_daily_archive(rows.filter("epoch % 3 = 2"), path)
    found, unread = archive.read_tree(spark, path)
    if not unread.isEmpty():
        raise ValueError("some files were not read")
    return found


@query(
    "s18_load_preview",
    f"""SELECT {_PARTS}, count(*) AS n_rows, count(DISTINCT mote_id) AS n_motes
        FROM {_COMPLETE} WHERE {_FOUR} GROUP BY 1, 2, 3""",
)
def load_preview(spark, sf_dir):
    return archive.load_preview(_complete(spark, sf_dir))


@query(
    "p16_recent_days",
    sql(
        f"""SELECT mote_id, updated_timestamp, {_METRICS} FROM folded
            WHERE CAST(updated_timestamp AS DATE) >
              (SELECT CAST(max(updated_timestamp) AS DATE) FROM folded) - 3""",
        "folded",
    ),
)
def recent_days(spark, sf_dir):
    rows = archive.read_mote_archive(spark, _written(spark, sf_dir))
    recent = rows.filter(archive.recent_days(tables.moved_clock(spark, sf_dir), 3))
    return recent.select("mote_id", "updated_timestamp", *METRICS)


@query(
    "p21_has_day",
    sql(
        """SELECT CAST(d AS DATE) AS date, (SELECT count(*) FROM folded
             WHERE CAST(updated_timestamp AS DATE) = d) > 0 AS present
           FROM (SELECT CAST(max(updated_timestamp) AS DATE) AS d FROM folded
                 UNION ALL SELECT CAST(max(updated_timestamp) AS DATE) + 1 FROM folded)""",
        "folded",
    ),
)
def has_day(spark, sf_dir):
    rows = archive.read_mote_archive(spark, _written(spark, sf_dir))
    today = tables.moved_clock(spark, sf_dir)
    days = [today, today + timedelta(days=1)]
    found = [(d.date(), archive.has_day(rows, d)) for d in days]
    return spark.createDataFrame(found, "date date, present boolean")


@query(
    "p20_partition_folders",
    sql(f"SELECT DISTINCT {_FOLDER} AS folder FROM folded", "folded"),
)
def partition_folders(spark, sf_dir):
    files = archive.inventory(spark, _written(spark, sf_dir))
    return files.filter(F.col("folder").isNotNull()).select("folder").distinct()


_TWO_PARTS = f"(SELECT {_FOLDER} AS folder, epoch % 2 AS part FROM folded)"


@query(
    "a20_inventory",
    sql(
        f"""SELECT folder, count(DISTINCT part) AS n_files, true AS has_bytes
            FROM {_TWO_PARTS} GROUP BY 1""",
        "folded",
    ),
)
def inventory(spark, sf_dir):
    files = archive.inventory(spark, _written(spark, sf_dir, parts=2))
    report = archive.inventory_report(files)
    return report.select("folder", "n_files", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "a33_compaction_dry_run",
    sql(
        f"""SELECT folder, count(DISTINCT part) AS n_files, count(*) AS n_rows,
            'dry_run' AS status FROM {_TWO_PARTS} GROUP BY 1 HAVING count(DISTINCT part) > 1""",
        "folded",
    ),
)
def compaction_dry_run(spark, sf_dir):
    return archive.compact(spark, _written(spark, sf_dir, parts=2), dry_run=True)


@query(
    "a33_compaction_report",
    sql(
        f"""SELECT count(*) AS n_folders, CAST(sum(f) AS BIGINT) AS n_files,
            CAST(sum(r) AS BIGINT) AS n_rows, count(*) AS n_ok, 0 AS n_partial, 0 AS n_error,
            0 AS n_dry_run FROM (SELECT folder, count(DISTINCT part) AS f, count(*) AS r
              FROM {_TWO_PARTS} GROUP BY 1 HAVING count(DISTINCT part) > 1)""",
        "folded",
    ),
)
def compaction_report(spark, sf_dir):
    report = archive.compact(spark, _written(spark, sf_dir, parts=2))
    return archive.compaction_totals(report)


@query(
    "s15_compacted_archive",
    sql(
        f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS}, 1 AS n_files
            FROM folded""",
        "folded",
    ),
)
def compacted_archive(spark, sf_dir):
    path = _written(spark, sf_dir, parts=2)
    archive.compact(spark, path)
    files = archive.inventory_report(archive.inventory(spark, path))
    rows = archive.read_mote_archive(spark, path).withColumn(
        "folder", F.concat_ws(
            "/",
            *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in archive.MOTE_PARTITIONS],
        )
    )
    return rows.join(files.select("folder", "n_files"), "folder", "left").select(
        "mote_id", "epoch", "timestamp", "updated_timestamp", *METRICS, "n_files"
    )


@query(
    "s15_unequal_columns",
    sql(
        f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS},
            CASE WHEN epoch % 2 = 1 THEN epoch * 2 END AS extra FROM folded""",
        "folded",
    ),
)
def compacted_unequal(spark, sf_dir):
    """Compaction of files of which only some have another column."""
    path, rows = scratch_path(spark, "archive"), _folded(spark, sf_dir)
    archive.write_mote_archive(rows.filter("epoch % 2 = 0"), path)
    extra = rows.filter("epoch % 2 = 1").withColumn("extra", F.col("epoch") * 2)
    archive.write_mote_archive(extra, path)
    archive.compact(spark, path)
    schema = StructType([*MOTE_ARCHIVE, StructField("extra", LongType())])
    found = spark.read.schema(schema).parquet(path)
    return found.select("mote_id", "epoch", "timestamp", "updated_timestamp", *METRICS, "extra")


_STEPS = {"first load": 2, "second load": 1, "rewritten": 1, "committed": 1, "first again": 2}


@query(
    "s15_snapshot_compaction",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{step}' AS step, mote_id, count(*) AS n_rows, CAST(sum(epoch) AS BIGINT) AS epochs,
                count(DISTINCT (CAST(updated_timestamp AS DATE), {"0" if step == "committed" else "epoch % 2"}))
                  AS n_files FROM folded WHERE epoch % {part} = 0 GROUP BY ALL"""
            for step, part in _STEPS.items()
        ),
        "folded",
    ),
)
def snapshot_compaction(spark, sf_dir):
    """What readers of a snapshot table see after each of two loads, while compaction has
    written its files but not committed them, after its commit, and of the first version."""
    table = SnapshotTable(spark, scratch_path(spark, "archive"))
    rows = archive.with_partitions(_folded(spark, sf_dir))
    mote = F.regexp_extract("folder", r"mote_id=(\d+)", 1).cast("int").alias("mote_id")

    def seen(step, version=None):
        counted = table.read(version).groupBy("mote_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("epoch").alias("epochs")
        )
        files = table.files(version).groupBy(mote).agg(F.count(F.lit(1)).alias("n_files"))
        return written(counted.join(files, "mote_id").withColumn("step", F.lit(step)), "seen")

    table.append(rows.filter("epoch % 2 = 0"))
    found = [seen("first load")]
    table.append(rows.filter("epoch % 2 = 1"))
    found.append(seen("second load"))
    changes, _ = table.rewrite()
    found.append(seen("rewritten"))
    table.commit(changes)
    found += [seen("committed"), seen("first again", 1)]
    return reduce(lambda a, b: a.unionByName(b), found)


@query(
    "u3_promoted_columns",
    sql(
        """SELECT mote_id, "timestamp", NULL AS humidity, temperature FROM sparse
           UNION ALL SELECT mote_id, "timestamp", humidity, NULL FROM sparse""",
        "sparse",
    ),
)
def promoted_columns(spark, sf_dir):
    rows = tables.sparse(spark, sf_dir)
    first = rows.select("mote_id", "timestamp", "temperature")
    second = rows.select("mote_id", "timestamp", "humidity")
    both = archive.combined_readings(first, second)
    return both.select("mote_id", "timestamp", "humidity", "temperature")


@query(
    "u1_combined_readings",
    sql(
        f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, {_METRICS} FROM sparse
            UNION ALL SELECT mote_id, NULL, "timestamp", NULL, {_METRICS} FROM dense""",
        "sparse",
        "dense",
    ),
)
def combined_readings(spark, sf_dir):
    return archive.combined_readings(
        tables.sparse(spark, sf_dir), tables.dense(spark, sf_dir)
    ).select(*READING.fieldNames())


@query(
    "j4_motes_in_both",
    sql(
        """SELECT mote_id FROM points INTERSECT SELECT CAST(mote_id AS VARCHAR) FROM dense""",
        "points",
        "dense",
    ),
)
def motes_in_both(spark, sf_dir):
    return joins.motes_in_both(tables.points(spark, sf_dir), tables.dense(spark, sf_dir))


@query(
    "j5_unseen_rows",
    sql(
        """SELECT mote_id, epoch, updated_timestamp FROM folded f WHERE NOT EXISTS (
             SELECT 1 FROM folded a WHERE a.epoch % 3 = 0 AND a.mote_id = f.mote_id
               AND a.updated_timestamp = f.updated_timestamp)""",
        "folded",
    ),
)
def unseen_rows(spark, sf_dir):
    rows = _folded(spark, sf_dir)
    path = scratch_path(spark, "archive")
    archive.write_mote_archive(rows.filter("epoch % 3 = 0"), path)
    new = joins.unseen(rows, archive.read_mote_archive(spark, path))
    return new.select("mote_id", "epoch", "updated_timestamp")


@query(
    "j6_recent_dates",
    sql(
        """SELECT mote_id, "timestamp" FROM sparse WHERE CAST(updated_timestamp AS DATE) IN
             (SELECT CAST(max(updated_timestamp) AS DATE) - CAST(i AS INTEGER) FROM sparse, range(3) t(i) GROUP BY i)""",
        "sparse",
    ),
)
def recent_dates(spark, sf_dir):
    rows = archive.with_partitions(tables.sparse(spark, sf_dir))
    recent = rows.filter(archive.recent_days(tables.moved_clock(spark, sf_dir), 3))
    return recent.select("mote_id", "timestamp")


@query(
    "f6_unplaced_rows",
    sql(
        """SELECT epoch, CASE WHEN epoch % 5 = 0 THEN 'no mote id' ELSE 'no remapped time' END
           AS reason FROM sparse WHERE epoch % 5 = 0 OR epoch % 7 = 0""",
        "sparse",
    ),
)
def unplaced_rows(spark, sf_dir):
    rows = tables.sparse(spark, sf_dir).withColumns(
        {
            "mote_id": F.when(F.col("epoch") % 5 > 0, F.col("mote_id")),
            "updated_timestamp": F.when(F.col("epoch") % 7 > 0, F.col("updated_timestamp")),
        }
    )
    return archive.unplaced(rows).select("epoch", "reason")


_STAMP = "%Y%m%d_%H%M%S"


@query(
    "f15_batch_keys",
    sql(
        f"""SELECT date, mote_id, first, last, n_rows, substr(sha256(first || '_' || last || '_' ||
              n_rows || '_' || mote_id), 1, 8) AS batch_key
            FROM (SELECT CAST(updated_timestamp AS DATE) AS date, mote_id,
              strftime(min(updated_timestamp), '{_STAMP}') AS first,
              strftime(max(updated_timestamp), '{_STAMP}') AS last, count(*) AS n_rows
              FROM folded GROUP BY 1, 2)""",
        "folded",
    ),
)
def batch_keys(spark, sf_dir):
    return dedup.batch_keys(_folded(spark, sf_dir))
