"""Snapshot tables: what readers see before, between and after the steps of a change."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sensorlake.sources import archive, rewrite, snapshots
from sensorlake.sources.snapshots import Conflict, SnapshotTable

KEYS = ("epoch", "mote_id", "updated_timestamp")


def readings(spark, n, start=0):
    at = "timestamp_ntz'2027-03-30 22:00:00' + make_dt_interval(0, 0, 30 * id)"
    rows = spark.range(start, start + n).select(
        F.col("id").alias("epoch"),
        F.expr(at).alias("timestamp"),
        F.expr(at).alias("updated_timestamp"),
        *[F.lit(1.5).alias(m) for m in ("temperature", "humidity", "light", "voltage")],
        (F.col("id") % 2 + 1).cast("int").alias("mote_id"),
    )
    return archive.with_partitions(rows)


def epochs(df):
    return sorted(r["epoch"] for r in df.select("epoch").collect())


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"))


def test_an_empty_table(table):
    assert table.versions() == [] and table.read().collect() == []
    assert table.files().collect() == []
    assert table.compact().collect() == []


def test_versions_stay_readable(spark, table):
    assert table.append(readings(spark, 4)) == 1
    assert table.append(readings(spark, 4, 4)) == 2
    assert epochs(table.read()) == list(range(8))
    assert epochs(table.read(version=1)) == [0, 1, 2, 3]
    row = table.read(version=1).where("epoch = 3").first()
    assert (row["mote_id"], row["year"], row["day"]) == (2, "2027", "30")


def test_readers_between_the_steps_of_a_compaction(spark, table):
    for i in range(3):
        table.append(readings(spark, 10, 10 * i))
    before, n_files = table.read(), table.files().count()
    changes, report = table.rewrite()
    assert {r["status"] for r in report.collect()} == {"ok"}
    assert epochs(table.read()) == list(range(30))  # the new files are not live yet
    table.append(readings(spark, 5, 30))  # a load arrives meanwhile
    table.commit(changes)
    assert epochs(table.read()) == list(range(35))
    assert epochs(before) == list(range(30))  # a reader that began before
    assert table.files().count() < n_files
    assert epochs(table.read(version=3)) == list(range(30))


def test_a_crash_at_any_step(spark, table, monkeypatch):
    for i in range(2):
        table.append(readings(spark, 6, 6 * i))

    def crash(*args, **kwargs):
        raise RuntimeError("power cut")

    places = [(rewrite, "merge"), (rewrite, "report"), (SnapshotTable, "commit"),
              (SnapshotTable, "files"), (snapshots._Log, "add")]
    for owner, name in places:
        with monkeypatch.context() as broken:
            broken.setattr(owner, name, crash)
            with pytest.raises(RuntimeError, match="power cut"):
                table.compact()
        assert epochs(table.read()) == list(range(12))
    with monkeypatch.context() as broken:
        broken.setattr(SnapshotTable, "commit", crash)
        with pytest.raises(RuntimeError, match="power cut"):
            table.append(readings(spark, 6, 12))
    assert epochs(table.read()) == list(range(12))
    table.compact()
    assert epochs(table.read()) == list(range(12)) and table.versions()[-1] == 3


def test_two_compactions_at_once(spark, table):
    for i in range(2):
        table.append(readings(spark, 6, 6 * i))
    first, _ = table.rewrite()
    second, _ = table.rewrite()
    table.commit(first)
    with pytest.raises(Conflict):
        table.commit(second)
    assert epochs(table.read()) == list(range(12))


def test_two_commits_at_once(spark, table, monkeypatch):
    """The second finds its version taken and comes after the first."""
    table.append(readings(spark, 2))
    other = SnapshotTable(spark, table.path)
    add = snapshots._Log.add

    def late(log, version, value):
        monkeypatch.setattr(snapshots._Log, "add", add)
        other.append(readings(spark, 2, 2))
        return add(log, version, value)

    monkeypatch.setattr(snapshots._Log, "add", late)
    assert table.append(readings(spark, 2, 4)) == 3
    assert epochs(table.read()) == list(range(6))
    assert not table.log.add(3, {})


def test_a_repeated_batch_counts_once(spark, table):
    for _ in range(2):
        table.append(readings(spark, 4), "source", 0)
    table.append(readings(spark, 4, 4), "source", 1)
    table.append(readings(spark, 4, 8), "another", 0)
    table.append(readings(spark, 4, 4), "source", 1)
    assert epochs(table.read()) == list(range(12))


def test_many_commits_fold(spark, table, monkeypatch):
    monkeypatch.setattr(snapshots, "FOLD", 3)
    for i in range(6):
        table.append(readings(spark, 1, i), "s", i)
    at = table.snapshot()
    assert at["base"] and len(at["lists"]) <= 3 and at["sources"] == {"s": 5}
    assert epochs(table.read()) == list(range(6))
    assert epochs(table.read(version=2)) == [0, 1]


def test_new_rows_read_only_their_days(spark, table):
    table.append(readings(spark, 400))  # nine days
    rows = readings(spark, 40, 10).withColumn("arrival", F.lit(1)).drop("year", "month", "day")
    day = F.date_format("updated_timestamp", "yyyy-MM-dd").alias("day")
    files = table.of_days(rows.select(day))
    assert {r["folder"][:25] for r in files.collect()} == {"year=2027/month=03/day=31"}
    table.append_new(rows)
    assert epochs(table.read()) == list(range(400))
    late = readings(spark, 3, 399).withColumn("arrival", F.lit(1)).drop("year", "month", "day")
    table.append_new(late.union(late))
    assert epochs(table.read()) == list(range(402))


def test_unreadable_files_stay(spark, table):
    for i in range(2):
        table.append(readings(spark, 2, 2 * i))
    path = table.files().orderBy("path").first()["path"]
    with open(f"{table.path}/{path}", "wb") as f:
        f.write(b"no parquet")
    report = table.compact()
    assert sorted(r["status"] for r in report.collect()) == ["ok", "partial"]
    assert path in {r["path"] for r in table.files().collect()}


def test_expired_files_go(spark, table):
    for i in range(3):
        table.append(readings(spark, 4, 4 * i))
    table.compact()
    listed = archive.list_files(spark, f"{table.path}/load=*")
    n = listed.count()
    table.expire(keep=1, before=datetime.now(timezone.utc) - timedelta(hours=1))
    assert archive.list_files(spark, f"{table.path}/load=*").count() == n
    table.expire(keep=1)
    assert archive.list_files(spark, f"{table.path}/load=*").count() == table.files().count()
    assert epochs(table.read()) == list(range(12)) and table.versions() == [4]
