"""Answers from rollups against the points themselves."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import rollups, timeseries
from sensorlake.schemas import MEASUREMENT

BEGIN = datetime(2027, 5, 30, 21, 58, 30)
KIND = "measurement string, mote_id string, _field string, _value double, _time timestamp_ntz"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    found = {}
    for _ in range(3000):
        at = BEGIN + timedelta(seconds=rng.choice((rng.random() * 4 * 86400, rng.random() * 400)))
        mote, field = str(rng.randint(1, 3)), rng.choice(("temperature", "light"))
        value = None if rng.random() < 0.05 else round(rng.gauss(20, 5), 2)
        found[mote, field, at] = (MEASUREMENT, mote, field, value, at)
    return list(found.values())


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollups") / "r")
    points = spark.createDataFrame(rows, KIND).coalesce(2).persist()
    half = F.xxhash64("_time") % 2 == 0
    rollups.write(points.filter(half), path)  # two loads merge
    rollups.write(points.filter(~half), path)
    return rollups.read(spark, path), points


@pytest.mark.parametrize("seed", range(50))
def test_pieces_cover_a_range_once(seed):
    rng = random.Random(seed)
    lo = datetime(1969, 12, 30) + timedelta(microseconds=rng.randrange(10**12))
    hi = lo + timedelta(microseconds=rng.choice((0, 1, 10**7, 10**9, 10**12)) + rng.randrange(10**6))
    found = rollups.pieces(lo, hi)
    at = lo
    for unit, a, b in found:
        assert a == at < b
        at = b
        if unit == "raw":
            assert b - a < 2 * rollups.UNITS["minute"]
        else:
            size = rollups.UNITS[unit]
            assert (a - rollups._EPOCH) % size == (b - rollups._EPOCH) % size == timedelta(0)
    assert at == hi or (not found and lo == hi)
    assert len(found) <= 7


def test_fifty_random_ranges(stored, rows):
    parts, points = stored
    rng = random.Random(5)
    answers, wanted = None, {}
    for i in range(50):
        lo = BEGIN + timedelta(seconds=rng.random() * 3 * 86400)
        hi = lo + timedelta(seconds=rng.choice((30, 500, 9000, 10**5)) * rng.random())
        mote = rng.choice((None, "2"))
        one = rollups.metric_summary(parts, points, "temperature", hi, lo, hi, mote)
        one = one.withColumn("i", F.lit(i))
        answers = one if answers is None else answers.unionByName(one)
        values = [v for _, m, f, v, t in rows if f == "temperature" and v is not None
                  and lo <= t < hi and mote in (None, m)]
        n = len(values)
        wanted[i] = (round(sum(values) / n, 4), min(values), max(values), n) if n else (None, None, None, 0)
    for r in answers.collect():
        mean, *rest = wanted[r["i"]]
        assert (r["min"], r["max"], r["count"]) == tuple(rest)
        assert r["mean"] == pytest.approx(mean, abs=1.1e-4) if rest[-1] else r["mean"] is None


def test_other_questions(stored):
    parts, points = stored
    as_of = BEGIN + timedelta(days=2, seconds=17)
    for ours, theirs, args in (
        (rollups.mean_of_means, timeseries.mean_of_means, ("light", as_of, "-31h")),
        (rollups.minute_mean, timeseries.minute_mean, ("light", as_of, "-47h")),
        (rollups.ingestion_rate, timeseries.ingestion_rate, (as_of, 400)),
    ):
        got, want = ours(parts, points, *args), theirs(points.filter("_value is not null"), *args)
        assert got.columns == want.columns
        both = [
            sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())
            for df in (got, want)
        ]
        assert both[0] == both[1] and both[0]


def test_the_inside_is_read_from_rollups(stored):
    """Only folders of the wanted units and days, and only points of the edges."""
    parts, points = stored
    lo, hi = BEGIN + timedelta(seconds=7), BEGIN + timedelta(days=3)
    found = rollups.in_range(parts, points, hi, lo, hi, "temperature")
    raw = [(a, b) for unit, a, b in rollups.pieces(lo, hi) if unit == "raw"]
    assert all(b - a < timedelta(minutes=1) for a, b in raw)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "unit" in plan.split("PartitionFilters: [")[1][:200]
    assert found.count() < points.filter("_field = 'temperature'").count()
