"""Distinct bitmaps, quantile sketches and samples that merge, against the rows themselves."""

import random
from bisect import bisect_left, bisect_right
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import samples, sketches, timeseries
from sensorlake.operators.distinct import NUMBERS, DistinctMotes
from sensorlake.operators.features import seeded_sample
from sensorlake.schemas import MEASUREMENT, POINT

BEGIN = datetime(2027, 6, 28, 22, 57, 10)
IDS = ["0", "7", "07", "32767", "32768", str(NUMBERS - 1), str(NUMBERS), "99999999999", "-3",
       "roof", "", " 7", "été", "7.0", "1e3"]


def rows_of_points(seed, n=1500):
    rng = random.Random(seed)
    return [
        (MEASUREMENT, rng.choice(IDS), "light", rng.random(),
         BEGIN + timedelta(seconds=rng.choice((rng.random() * 3 * 86400, rng.random() * 900))))
        for _ in range(n)
    ] + [(MEASUREMENT, None, "light", 1.0, BEGIN), (MEASUREMENT, "9", "light", 1.0, None),
         ("other", "11", "light", 1.0, BEGIN)]


@pytest.fixture(scope="module")
def motes(spark, tmp_path_factory):
    rows = rows_of_points(2)
    points = spark.createDataFrame(rows, POINT).coalesce(2).persist()
    found = DistinctMotes(spark, str(tmp_path_factory.mktemp("motes") / "m"))
    half = F.xxhash64("_time") % 2 == 0
    found.add(points.filter(half))
    found.add(points.filter(~half | F.col("_time").isNull()))
    found.add(points.filter(half))  # a load once more
    return found, points, rows


def test_motes_of_ranges(motes):
    found, points, rows = motes
    rng = random.Random(3)
    answers, wanted = None, {}
    for i in range(30):
        lo = BEGIN + timedelta(seconds=rng.random() * 2 * 86400)
        hi = lo + timedelta(seconds=rng.choice((0, 20, 500, 9000, 10**5)) * rng.random())
        one = found.count(points, hi, lo, hi).withColumn("i", F.lit(i))
        answers = one if answers is None else answers.unionByName(one)
        wanted[i] = len({r[1] for r in rows if r[0] == MEASUREMENT and r[1] is not None
                         and r[4] is not None and lo <= r[4] < hi})
    assert {r["i"]: r["n_motes"] for r in answers.collect()} == wanted
    assert len(set(wanted.values())) > 5


def test_motes_as_the_points_say(motes):
    found, points, rows = motes
    as_of = BEGIN + timedelta(minutes=12, seconds=3)
    assert found.active_motes(points, as_of).collect() == timeseries.active_motes(points, as_of).collect()
    inside = timeseries.select_points(points, as_of, "-24h").filter("mote_id is not null")
    assert (found.mote_count_check(points, as_of).collect()
            == timeseries.mote_count_check(inside).collect())
    days = defaultdict(set)
    for kind, mote, _, _, at in rows:
        if kind == MEASUREMENT and mote is not None and at is not None:
            days[at.date()].add(mote)
    assert dict(map(tuple, found.per_day().collect())) == {d: len(m) for d, m in days.items()}


def test_codes_are_distinct_and_stay(motes):
    found = motes[0]
    codes = dict(map(tuple, found._known().collect()))
    assert len(set(codes.values())) == len(codes) == found._known().count()
    assert min(codes.values()) >= NUMBERS and "7" not in codes and "07" in codes


def test_whole_minutes_read_no_points(motes, spark):
    found, _, rows = motes
    lo, hi = datetime(2027, 6, 28, 23, 1), datetime(2027, 7, 1, 4, 9)
    none = spark.createDataFrame([], POINT)
    wanted = {r[1] for r in rows if r[0] == MEASUREMENT and r[1] is not None and r[4] and lo <= r[4] < hi}
    assert found.count(none, hi, lo, hi).first()[0] == len(wanted)


def test_no_motes(spark, tmp_path):
    found = DistinctMotes(spark, str(tmp_path / "m"))
    none = spark.createDataFrame([], POINT)
    found.add(none)
    assert found.count(none, BEGIN, "-24h").first()[0] == 0 and found.per_day().count() == 0


def rank_error(values, value, p):
    """How far the ranks of a value are from p."""
    lo, hi = bisect_left(values, value) / len(values), bisect_right(values, value) / len(values)
    return max(0.0, lo - p, p - hi)


def test_sketches_within_their_error(spark, tmp_path):
    path = str(tmp_path / "s")
    n, loads = 60000, 4
    ids = spark.range(n).select(
        F.lit(MEASUREMENT).alias("measurement"), (F.col("id") % 3).cast("string").alias("mote_id"),
        F.lit("light").alias("_field"),
        F.when(F.col("id") % 50 > 0, F.pow(F.randn(7), 3) + F.col("id") % 3).alias("_value"),
        F.timestamp_seconds(F.lit(1_800_000_000) + F.col("id") * 13)
        .cast("timestamp_ntz").alias("_time"),
        (F.col("id") % loads).alias("load"),
    ).persist()
    for load in range(loads):
        sketches.write(ids.filter(F.col("load") == load).drop("load"), path)
    kept = sketches.read(spark, path)
    assert kept.select("date").distinct().count() > 5
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    values = defaultdict(list)
    for r in ids.filter("_value is not null").collect():
        values[r["mote_id"]].append((r["_value"], r["_time"].date()))
    for mote, got in sketches.quantiles(kept, ["mote_id"], ps).collect():
        own = sorted(v for v, _ in values[mote])
        assert (got[0], got[-1]) == (own[0], own[-1])
        assert max(rank_error(own, v, p) for v, p in zip(got, ps)) <= sketches.RANK_ERROR
    days = sorted({d for v in values.values() for _, d in v})[1:4]
    some = sketches.of_days(kept, days[0], days[-1])
    for mote, got in sketches.quantiles(some, ["mote_id"], [0.5]).collect():
        own = sorted(v for v, d in values[mote] if d in days)
        assert rank_error(own, got[0], 0.5) <= sketches.RANK_ERROR
    box = sketches.box_summary(kept, "light", 2).collect()
    assert [r["mote_id"] for r in box] == sorted(values, key=lambda m: (-len(values[m]), m))[:2]
    every = sorted(v for vs in values.values() for v, _ in vs)
    assert rank_error(every, sketches.medians(kept)["light"], 0.5) <= sketches.RANK_ERROR


def test_small_groups_are_exact(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(MEASUREMENT, "1", "light", float(v), BEGIN) for v in (5, 1, 4, 2, 3)]
    rows += [(MEASUREMENT, "1", "light", v, BEGIN) for v in (None, float("nan"))]
    rows += [(MEASUREMENT, "2", "light", None, BEGIN), (MEASUREMENT, "1", "light", 99.0, None)]
    sketches.write(spark.createDataFrame(rows, POINT), path)
    got = sketches.quantiles(sketches.read(spark, path), ["mote_id"], [0.0, 0.5, 1.0]).collect()
    assert [tuple(r) for r in got] == [("1", [1.0, 3.0, 5.0])]


def test_few_points_per_sketch_are_dealt_by_day(spark, tmp_path):
    """Most motes have one point a day, one mote has most of a large day: the points of a day
    are dealt to several tasks, which write them where they are, and nothing is lost."""
    path = str(tmp_path / "s")
    rows = [(MEASUREMENT, str(i), "light", float(i % 97), BEGIN + timedelta(days=i % 3))
            for i in range(600)]
    rows += [(MEASUREMENT, "hot", "light", float(i), BEGIN + timedelta(seconds=i)) for i in range(400)]
    rows += [(MEASUREMENT, None, "light", 7.0, BEGIN), (MEASUREMENT, "1", "light", None, BEGIN)]
    sketches.write(spark.createDataFrame(rows, POINT), path, points_per_task=100)
    kept = sketches.read(spark, path)
    files = kept.groupBy("date", F.input_file_name()).agg(F.sum("n").alias("n")).collect()
    sizes = defaultdict(list)
    for day, _, n in files:
        sizes[day].append(n)
    whole = [sum(v) for v in sizes.values()]
    assert sum(whole) == 1001 and max(map(max, sizes.values())) < max(whole) / 2
    values = defaultdict(list)
    for _, mote, _, v, _ in rows:
        if v is not None:
            values[mote].append(v)
    got = {r[0]: (r["n"], r["least"], r["most"]) for r in sketches.merged(kept, "mote_id").collect()}
    assert got == {m: (len(v), min(v), max(v)) for m, v in values.items()}
    top = sketches.box_summary(kept, "light", 1).first()
    own = sorted(values["hot"])
    assert top["mote_id"] == "hot" and (top["min"], top["max"]) == (0.0, 399.0)
    assert rank_error(own, top["median"], 0.5) <= sketches.RANK_ERROR


@pytest.mark.parametrize("n", [1, 40, 200])
def test_merged_sample_is_that_of_the_whole(spark, tmp_path, n):
    rng = random.Random(5)
    rows = [(i, rng.random(), None if i % 97 == 0 else BEGIN + timedelta(hours=rng.random() ** 4 * 200))
            for i in range(3000)]
    whole = spark.createDataFrame(rows, "id long, v double, timestamp timestamp_ntz")
    path = str(tmp_path / "s")
    for load in range(3):
        samples.write(whole.filter(F.col("id") % 3 == load), path, 200, ["id"])
    kept = samples.read(spark, path, whole.schema)
    key = ["id"]
    assert sorted(samples.sample(kept, n, key).collect(), key=str) == sorted(
        seeded_sample(whole, n, key).collect(), key=str)
    days = (date(2027, 6, 29), date(2027, 7, 2))
    some = whole.filter(F.col("timestamp").cast("date").between(*days))
    got = samples.sample(kept, n, key, days)
    assert got.columns == whole.columns
    assert sorted(got.collect(), key=str) == sorted(seeded_sample(some, n, key).collect(), key=str)
    assert kept.groupBy("_date").count().agg(F.max("count")).first()[0] <= 600
