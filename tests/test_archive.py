"""Archive sinks, readers and compaction."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlake import session
from sensorlake.operators import dedup, joins
from sensorlake.schemas import METRICS
from sensorlake.sources import archive


def readings(spark, n=60, null_light=()):
    rows = spark.range(n).select(
        (F.col("id") % 3 + 1).cast("int").alias("mote_id"),
        F.col("id").alias("epoch"),
        F.expr("timestamp_ntz'2004-02-28 23:00:00' + make_dt_interval(0, 0, id)").alias("timestamp"),
        F.expr("timestamp_ntz'2026-02-28 23:30:00' + make_dt_interval(0, 0, id)").alias(
            "updated_timestamp"
        ),
        F.col("id").cast("double").alias("temperature"),
        F.lit(40.5).alias("humidity"),
        F.when(~F.col("id").isin(*null_light, -1), 100.0).alias("light"),
        F.lit(2.5).alias("voltage"),
    )
    return rows


def keys(df):
    return sorted(map(tuple, df.select("mote_id", "epoch", *METRICS).collect()), key=str)


def test_mote_archive_layout(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark, null_light=(5,))
    archive.write_mote_archive(rows, path)
    assert os.path.isdir(f"{path}/year=2026/month=02/day=28/mote_id=1")
    assert os.path.isdir(f"{path}/year=2026/month=03/day=01/mote_id=3")
    read = archive.read_mote_archive(spark, path)
    assert keys(read) == keys(rows)
    assert {r["month"] for r in read.select("month").distinct().collect()} == {"02", "03"}
    recent = read.filter(archive.recent_days(datetime(2026, 3, 1, 5), 1))
    assert recent.count() == 30
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan
    assert archive.has_day(read, datetime(2026, 2, 28)) and not archive.has_day(
        read, datetime(2026, 2, 27)
    )


def test_rows_without_place(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark, 10).withColumn(
        "updated_timestamp", F.when(F.col("epoch") > 2, F.col("updated_timestamp"))
    )
    archive.write_mote_archive(rows, path)
    assert archive.read_mote_archive(spark, path).count() == 7
    assert archive.unplaced(rows).select("reason").distinct().first()[0] == "no remapped time"


def test_daily_archive(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = readings(spark, null_light=(1, 2))
    archive.write_daily_archive(rows, path)
    raw = spark.read.parquet(path)
    assert dict(raw.dtypes)["temperature"] == "float" and raw.count() == 58
    read = archive.read_daily_archive(spark, path)
    first = read.orderBy("timestamp").first()
    assert first["timestamp"] == datetime(2004, 2, 28, 23, 0)
    preview = archive.load_preview(rows).orderBy("day").collect()
    assert [(r["day"], r["n_rows"], r["n_motes"]) for r in preview] == [("01", 30, 3), ("28", 28, 3)]


def test_layouts_combine(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    archive.write_mote_archive(readings(spark), a)
    archive.write_daily_archive(readings(spark), b)
    both = archive.combined_readings(
        archive.read_mote_archive(spark, a), archive.read_daily_archive(spark, b)
    )
    assert both.count() == 120 and both.filter("epoch is null").count() == 60


def test_text_times(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark, 3).withColumn("timestamp", F.col("timestamp").cast("string"))
    archive.write_mote_archive(rows, path)
    read = archive.read_mote_archive(spark, path, text_times=True)
    assert read.agg(F.min("timestamp")).first()[0] == datetime(2004, 2, 28, 23, 0)


def files_per_folder(spark, path):
    report = archive.inventory_report(archive.inventory(spark, path))
    return {r["folder"]: r["n_files"] for r in report.collect()}


def test_compaction_keeps_rows_and_runs_once(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark)
    for i in range(3):
        archive.write_mote_archive(rows.filter(F.floor(F.col("epoch") / 3) % 3 == i), path)
    assert set(files_per_folder(spark, path).values()) == {3}
    dry = archive.compact(spark, path, dry_run=True)
    assert dry.agg(F.sum("n_rows")).first()[0] == 60
    kept = archive.compact(spark, path, keep_originals=True)
    assert kept.count() == 6 and set(files_per_folder(spark, path).values()) == {3}
    report = archive.compact(spark, path)
    assert {r["status"] for r in report.collect()} == {"ok"}
    assert set(files_per_folder(spark, path).values()) == {1}
    assert keys(archive.read_mote_archive(spark, path)) == keys(rows)
    assert archive.compact(spark, path).count() == 0
    assert keys(archive.read_mote_archive(spark, path)) == keys(rows)


def test_compaction_leaves_folder_with_unreadable_file(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark)
    for i in range(2):
        archive.write_mote_archive(rows.filter(F.floor(F.col("epoch") / 3) % 2 == i), path)
    broken = f"{path}/year=2026/month=02/day=28/mote_id=1/part-broken.parquet"
    with open(broken, "w") as f:
        f.write("not a parquet file")
    status = {r["folder"]: r["status"] for r in archive.compact(spark, path).collect()}
    assert status.pop("year=2026/month=02/day=28/mote_id=1") == "partial"
    assert set(status.values()) == {"ok"} and os.path.exists(broken)
    assert files_per_folder(spark, path)["year=2026/month=02/day=28/mote_id=1"] == 3
    assert keys(archive.read_tree(spark, path)[0]) == keys(rows)


def test_compaction_of_one_folder_and_foreign_files(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark)
    for i in range(2):
        archive.write_mote_archive(rows.filter(F.floor(F.col("epoch") / 3) % 2 == i), path)
    folder = "year=2026/month=03/day=01/mote_id=2"
    report = archive.compact(spark, path, only=folder).collect()
    assert [r["folder"] for r in report] == [folder]
    assert len(glob.glob(f"{path}/{folder}/*.parquet")) == 1
    assert archive.compaction_plan(archive.inventory(spark, path), limit=2).count() == 2
    assert archive.compaction_plan(archive.inventory(spark, path), min_files=3).count() == 0


def test_compaction_keeps_columns_and_late_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    rows = readings(spark, 12)
    for i in range(2):
        part = rows.filter(F.floor(F.col("epoch") / 3) % 2 == i)
        archive.write_mote_archive(part.withColumn(f"extra{i}", F.lit(i)), path)
    late = readings(spark, 15).filter("epoch >= 12")
    staged = archive.written

    def slow(df, name):
        out = staged(df, name)
        if name == "compaction":
            archive.write_mote_archive(late, path)
        return out

    monkeypatch.setattr(archive, "written", slow)
    archive.compact(spark, path)
    read = spark.read.option("mergeSchema", "true").parquet(path)
    assert read.count() == 15
    sums = read.agg(F.count("extra0"), F.count("extra1")).first()
    assert tuple(sums) == (6, 6)


def test_compaction_of_files_that_disagree(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = readings(spark, 6)
    archive.write_mote_archive(rows, path)
    archive.write_mote_archive(rows.filter("mote_id < 3"), path)
    archive.write_mote_archive(
        rows.filter("mote_id = 3").withColumn("timestamp", F.col("timestamp").cast("string")), path
    )
    status = {r["folder"][-1]: r["status"] for r in archive.compact(spark, path).collect()}
    assert status == {"1": "ok", "2": "ok", "3": "error"}
    found, unread = archive.read_tree(spark, path)
    assert found.count() == 12 and unread.count() == 0


def test_unreadable_files_are_told(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.write_mote_archive(readings(spark), path)
    broken = f"{path}/year=2026/month=02/day=28/mote_id=1/part-broken.parquet"
    with open(broken, "w") as f:
        f.write("not a parquet file")
    with pytest.raises(Exception, match="(?i)parquet"):
        archive.read_mote_archive(spark, path).agg(F.sum("temperature")).collect()
    rows, unread = archive.read_tree(spark, path)
    assert keys(rows) == keys(readings(spark))
    assert [r["path"].endswith("part-broken.parquet") for r in unread.collect()] == [True]


def test_dedup(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1, 10), (1, "a", 2, 20), (2, "a", 3, 30), (1, None, 4, 40), (1, None, 5, 50)],
        "mote_id int, t string, arrival int, v int",
    )
    kept = dedup.first_per_key(rows, ["mote_id", "t"], ["arrival"])
    assert sorted(r["v"] for r in kept.collect()) == [10, 30, 40, 50]


def test_copies_are_dropped_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 2 as mote_id", "id % 3 as t", "id as arrival")
    kept = dedup.first_per_key(rows, ["mote_id", "t"], ["arrival"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_unseen_and_both(spark):
    rows = readings(spark, 10)
    known = rows.filter("epoch < 4")
    assert joins.unseen(rows, known).count() == 6
    motes = joins.motes_in_both(rows, spark.createDataFrame([("2",), ("9",)], "mote_id string"))
    assert [r[0] for r in motes.collect()] == ["2"]


def test_completeness(spark):
    rows = readings(spark, 10)
    stored = spark.range(34)
    got = joins.load_completeness(rows, stored).first()
    assert tuple(got) == (40, 34, 85.0, "partial")
    assert joins.load_completeness(rows, spark.range(38)).first()["status"] == "passed"
    assert joins.load_completeness(rows.limit(0), stored).first()["status"] == "failed"


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert configured is None or folder == configured.rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


@pytest.mark.parametrize("path,folder", [
    ("s3://b/year=2026/month=02/day=10/mote_id=1084/x.parquet", "year=2026/month=02/day=10/mote_id=1084"),
    ("s3://b/compacted.parquet", None),
    ("s3://b/year=2026/month=02/day=10/data.parquet", None),
])
def test_folder_of(spark, path, folder):
    df = spark.createDataFrame([(path,)], "path string")
    assert df.select(archive.folder_of(F.col("path"))).first()[0] == folder
