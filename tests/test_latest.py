"""The table of newest values against the points themselves."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import timeseries
from sensorlake.schemas import MEASUREMENT, METRICS, POINT
from sensorlake.streaming import latest

BEGIN = datetime(2027, 3, 1, 6)


def made(seed, n=400, motes=9):
    rng = random.Random(seed)
    return [
        (MEASUREMENT, str(rng.randint(1, motes)), rng.choice(METRICS),
         None if rng.random() < 0.05 else round(rng.random(), 4),
         BEGIN + timedelta(seconds=rng.randrange(90000)))
        for _ in range(n)
    ]


def expected(batches):
    """The newest point per series; of equal times the one of the last batch."""
    found = {}
    for rows in batches:
        best = {}
        for _, mote, field, value, at in rows:
            if mote is not None and field is not None and at is not None:
                if (mote, field) not in best or at > best[mote, field][1]:
                    best[mote, field] = (value, at)
        for key, (value, at) in best.items():
            if key not in found or at >= found[key][1]:
                found[key] = (value, at)
    return found


def shown(table, **kw):
    return {(r["mote_id"], r["_field"]): (r["_value"], r["_time"]) for r in table.rows(**kw).collect()}


def distinct_times(rows):
    return list({r[1:3] + r[4:]: r for r in rows}.values())


@pytest.mark.parametrize("fold_every", [2, 1000])
def test_late_and_repeated_batches(spark, tmp_path, monkeypatch, fold_every):
    monkeypatch.setattr(latest, "FOLD_EVERY", fold_every)
    table = latest.LatestTable(spark, str(tmp_path / "t"))
    rows = distinct_times(made(3))
    odd = [(MEASUREMENT, None, "light", 1.0, BEGIN), (MEASUREMENT, "3", None, 1.0, BEGIN),
           (MEASUREMENT, "3", "light", 1.0, None)]
    late = sorted(rows, key=lambda r: r[4], reverse=True)
    batches = [late[:100] + odd, late[100:250], late[250:], odd]
    for i, batch in enumerate(batches):
        for _ in range(2):  # a repeated batch changes nothing
            table.upsert(spark.createDataFrame(batch, POINT), "s", i)
    assert shown(table) == expected(batches)
    for mote in ("1", "7", "none"):
        assert shown(table, mote_id=mote) == {
            k: v for k, v in expected(batches).items() if k[0] == mote
        }
    as_of = BEGIN + timedelta(days=2)
    points = spark.createDataFrame(rows, POINT)
    for ours, theirs in ((table.values, timeseries.latest_values),
                         (table.points, timeseries.latest_points),
                         (table.reading, timeseries.latest_reading)):
        got, want = ours(as_of, "-30h"), theirs(points, as_of, "-30h")
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_fold_keeps_one_row_per_series(spark, tmp_path):
    table = latest.LatestTable(spark, str(tmp_path / "t"))
    batches = [made(i, 60, 3) for i in range(5)]
    for i, batch in enumerate(batches):
        table.upsert(spark.createDataFrame(distinct_times(batch), POINT), "s", i)
    before, reader = shown(table), table.rows()
    table.fold()
    assert shown(table) == before == expected([distinct_times(b) for b in batches])
    assert table.table.read().count() == len(before)
    assert reader.count() == len(before)  # a reader of the old version goes on with it
    table.fold()
    assert shown(table) == before


def test_equal_times_go_to_the_last_written(spark, tmp_path):
    table = latest.LatestTable(spark, str(tmp_path / "t"))
    for i, value in enumerate((1.0, 2.0, 3.0)):
        rows = [(MEASUREMENT, "1", "light", value, BEGIN)]
        table.upsert(spark.createDataFrame(rows, POINT), "s", i)
    assert shown(table) == {("1", "light"): (3.0, BEGIN)}
    rows = [(MEASUREMENT, "1", "light", float(v), BEGIN) for v in (4, 9, 6)]
    numbered = spark.createDataFrame(rows, POINT).withColumn("arrival", -F.col("_value"))
    table.upsert(numbered, "s", 3, ("arrival",))
    assert shown(table) == {("1", "light"): (4.0, BEGIN)}


def test_a_clock_ahead_and_an_empty_table(spark, tmp_path):
    table = latest.LatestTable(spark, str(tmp_path / "t"))
    assert table.rows().count() == 0 and table.newest_record().first()["mote_id"] is None
    table.upsert(spark.createDataFrame([], POINT), "s", 0)
    assert table.reading(BEGIN).count() == 0
    rows = [(MEASUREMENT, "1", "light", 1.0, BEGIN), (MEASUREMENT, "2", "light", 2.0, BEGIN + timedelta(days=9))]
    table.upsert(spark.createDataFrame(rows, POINT), "s", 1)
    as_of = BEGIN + timedelta(minutes=1)
    assert [r["mote_id"] for r in table.reading(as_of).collect()] == ["1"]
    assert [r["mote_id"] for r in table.ahead(as_of).collect()] == ["2"]


def test_one_mote_reads_one_bucket(spark, tmp_path):
    table = latest.LatestTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame(made(8, 2000, 200), POINT), "s", 0)
    assert len(table.rows().inputFiles()) > 20
    assert len(table.rows(mote_id="17").inputFiles()) == 1
