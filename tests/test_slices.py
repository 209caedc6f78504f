"""Sliced windows against plain ones, also with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorlake import session
from sensorlake.operators import clean, profile, remap, slices


def skewed(spark, n=600, seed=1, ties=False):
    """Two thirds of the rows belong to key 1, and half of those to one short burst."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.66, 1, rng.integers(2, 9, n))
    at = np.where(rng.random(n) < 0.5, rng.integers(0, 1_000_000, n), rng.integers(500, 600, n))
    if ties:
        at = at // 50
    value = np.where(rng.random(n) < 0.3, rng.normal(size=n).round(2), np.nan)
    pdf = pd.DataFrame({"key": key, "at": at, "id": range(n), "value": value})
    return spark.createDataFrame(
        [(int(k), int(a), int(i), None if np.isnan(v) else float(v)) for k, a, i, v in
         pdf.itertuples(index=False)],
        "key int, at long, id long, value double",
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("ties", [False, True])
def test_forward_fill(spark, ties):
    df = skewed(spark, ties=ties)
    args = (["key"], "at", ["at", "id"], "value")
    sliced, was_cut = slices.cut(df, ["key"], "at", 20)
    assert was_cut and sliced.select("key", "_slice").distinct().count() > 20
    assert rows(slices.forward_fill(df, *args, rows_per_slice=20)) == rows(
        slices.forward_fill(df, *args)
    )
    pdf = df.toPandas().sort_values(["key", "at", "id"])
    pdf["value"] = pdf.groupby("key")["value"].ffill()
    ours = slices.forward_fill(df, *args, rows_per_slice=20).toPandas()
    merged = ours.merge(pdf, on="id", suffixes=("", "_p"))
    pd.testing.assert_series_equal(merged["value"], merged["value_p"], check_names=False)


def test_slices_stay_small(spark):
    sliced, _ = slices.cut(skewed(spark, 2000), ["key"], "at", 50)
    largest = sliced.groupBy("key", "_slice", "at").count().groupBy("key", "_slice").count()
    sizes = sliced.groupBy("key", "_slice").count().toPandas()["count"]
    assert sizes.max() <= 250 and largest.count() == len(sizes)


def test_uncut_when_small(spark):
    _, was_cut = slices.cut(skewed(spark), ["key"], "at")
    assert not was_cut


@pytest.mark.parametrize("limit", [7, 60, 10_000])
def test_positions(spark, limit):
    df = skewed(spark)
    numbered = slices.positions(df, [], "at", ["at", "id"], "p", limit).toPandas()
    expected = numbered.sort_values(["at", "id"]).reset_index(drop=True)
    assert (expected["p"] == expected.index).all()


@pytest.mark.parametrize("limit", [15, 10_000])
def test_previous_time(spark, limit):
    df = skewed(spark)
    got = slices.previous_time(df, ["key"], "at", "at", ["at", "id"], "prev", limit).toPandas()
    got = got.sort_values(["key", "at", "id"])
    expected = got.groupby("key")["at"].shift(1)
    pd.testing.assert_series_equal(
        got["prev"].astype(float), expected.astype(float), check_names=False
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-20, 20).map(float))),
        min_size=1,
        max_size=60,
    ),
    limit=st.sampled_from([1, 3, 1000]),
)
def test_exact_quantiles(spark, values, limit):
    df = spark.createDataFrame(values, "g int, v double")
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = {
        r["g"]: r["quantiles"]
        for r in slices.exact_quantiles(df, ["g"], "v", probabilities, limit).collect()
    }
    groups = {}
    for g, v in values:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, probabilities))


def test_exact_quantile_of_copies(spark):
    df = spark.range(900).selectExpr("cast(if(id % 3 > 0, 7, id) as double) as v")
    expected = np.quantile(df.toPandas()["v"], [0.1, 0.5, 0.99])
    for limit in (10, 10_000):
        got = slices.exact_quantiles(df, [], "v", [0.1, 0.5, 0.99], limit).first()[0]
        assert np.allclose(got, expected)


@pytest.mark.parametrize("limit", [7, 10_000])
def test_one_instant_is_cut_by_the_next_column(spark, limit):
    df = spark.range(300).selectExpr("cast(1 as int) as key", "7L as at", "id", "if(id % 40 = 3, id, null) as value")
    sliced, was_cut = slices.cut(df, ["key"], "at", limit, ["id"])
    sizes = sliced.groupBy("_slice").count().toPandas()["count"]
    assert was_cut == (limit == 7) and sizes.max() <= max(35, limit)
    order = ["at", "id"]
    filled = slices.forward_fill(df, ["key"], "at", order, "value", None, limit, ["id"])
    expected = [(i, max((v for v in range(3, i + 1, 40)), default=None)) for i in range(300)]
    assert sorted((r["id"], r["value"]) for r in filled.collect()) == expected
    numbered = slices.positions(df, [], "at", order, "p", limit, ["id"]).collect()
    assert all(r["p"] == r["id"] for r in numbered)
    before = slices.previous_time(df, ["key"], "at", "at", order, "prev", limit, ["id"]).collect()
    assert all(r["prev"] == (7 if r["id"] else None) for r in before)


def test_earliest_rows_are_in_order(spark):
    df = spark.range(500).selectExpr(
        "cast(timestamp'2024-01-01' as timestamp_ntz) + make_dt_interval(0, 0, int(id % 2)) as timestamp",
        "id * 7 % 500 as mote_id",
    )
    expected = sorted((r["timestamp"], r["mote_id"]) for r in df.collect())
    for n in (3, 300, 900):
        got = profile.earliest_rows(df, n, "timestamp", ("mote_id",), 40).collect()
        assert [tuple(r) for r in got] == expected[:n]


def test_few_rows_are_numbered_for_the_first(spark, monkeypatch):
    """Times may be null, which come first; only candidates of the first rows are numbered."""
    df = spark.range(40_000).selectExpr(
        "if(id < 5, null, cast(timestamp'2024-01-01' as timestamp_ntz)"
        " + make_dt_interval(0, 0, 0, id div 2)) as timestamp", "id * 7 % 40000 as mote_id",
    )
    numbered = []

    def positions(rows, *args):
        numbered.append(rows.count())
        return slices.positions(rows, *args)

    monkeypatch.setattr(profile, "positions", positions)
    got = profile.earliest_rows(df, 30, "timestamp", ("mote_id",), 64).collect()
    assert got == df.orderBy("timestamp", "mote_id").limit(30).collect()
    assert numbered[0] < 100


def test_cuts_read_the_rows_seldom(spark, monkeypatch):
    """One pass finds what is too large in any column, and the search for a row's slice is
    compiled, not a function over an array."""
    names = []

    def written(df, name):
        names.append(name)
        return session.written(df, name)

    monkeypatch.setattr(slices, "written", written)
    df = spark.range(4000).selectExpr("id", "id div 4 as at", "1L as a", "2L as b")
    sliced, was_cut = slices.cut(df, [], "at", 1000, ["a", "b", "id"])
    assert was_cut and names == ["large-groups", "cut-points", "large-groups"]
    assert "lambda" not in sliced._jdf.queryExecution().executedPlan().toString()


def test_quantiles_count_only_the_values_of_their_slices(spark):
    df = spark.range(5000).selectExpr("cast(id * 7 % 5000 as double) as v")
    found = slices.exact_quantiles(df, [], "v", [0.5], 250)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert np.allclose(found.first()[0], [2499.5])
    counted = plan.index("Aggregate [_slice")
    assert counted < plan.index("Join Inner")  # the join is below the count


def test_position_split_and_sample(spark):
    df = spark.range(1000).selectExpr("id", "id * 3 as at")
    first, rest = remap.position_split(df, "at", ["at"], 0.8, 64)
    assert first.agg({"id": "max"}).first()[0] == 799
    assert first.count() == 800 and rest.count() == 200
    sample = profile.systematic_sample(df, "at", ["at"], every=100, rows_per_slice=64)
    assert [r["id"] for r in sample.collect()] == [0, 1, 2, 100, 200, 300, 400, 500, 600, 700]
    with pytest.raises(ValueError):
        remap.position_split(df, "at", ["at"], 1.0)


def test_position_split_of_a_burst(spark):
    """All rows at one instant are cut along the tie column, and no task gets them all."""
    df = spark.range(900).selectExpr("id * 7 % 900 as id", "5L as at")
    cut, was_cut = slices.cut(df, [], "at", 64, ["id"])
    assert was_cut and cut.groupBy("_slice").count().agg({"count": "max"}).first()[0] <= 130
    first, rest = remap.position_split(df, "at", ["at", "id"], 0.5, 64, ["id"])
    assert sorted(r["id"] for r in first.collect()) == list(range(450))
    assert rest.agg({"id": "min"}).first()[0] == 450
    sample = profile.systematic_sample(
        df, "at", ["at", "id"], every=100, rows_per_slice=64, ties=["id"]
    )
    assert [r["id"] for r in sample.collect()] == [0, 1, 2, *range(100, 800, 100)]


def test_voltage_leak_between_motes(spark):
    data = [
        (1, 1, None), (1, 2, 2.5), (1, 3, None),
        (2, 1, None), (2, 2, None),
        (3, 1, None), (3, 2, 2.9),
        (4, 1, None),
    ]
    df = spark.createDataFrame(
        [(m, f"2024-01-01 00:00:0{t}", t, v) for m, t, v in data],
        "mote_id int, t string, epoch int, voltage double",
    ).selectExpr("mote_id", "cast(t as timestamp_ntz) as timestamp", "epoch", "voltage")

    def filled(**options):
        got = clean.fill_voltage(df, **options).orderBy("mote_id", "epoch").collect()
        return [r["voltage"] for r in got]

    leaked = [2.5, 2.5, 2.5, 2.9, 2.9, 2.9, 2.9, None]
    assert filled() == leaked == filled(rows_per_slice=1)
    assert filled(cross_mote_backfill=False) == [2.5, 2.5, 2.5, None, None, 2.9, 2.9, None]
