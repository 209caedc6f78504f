"""Rules, severity, bounds and the forest."""

from datetime import datetime
from itertools import product
from time import process_time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.functions import scores
from sensorlake.operators import clean, features, forest, models, profile, scan
from sensorlake.schemas import FEATURES

GOOD = {"temperature": 20.0, "humidity": 50.0, "light": 100.0, "voltage": 2.9}
BAD = {"temperature": 50.0, "humidity": 95.0, "light": 2500.0, "voltage": 1.9}
PENALTY = {"temperature": 0.4, "humidity": 0.3, "light": 0.2, "voltage": 0.3}
SCHEMA = "mote_id int, temperature double, humidity double, light double, voltage double"


def readings(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_all_violations(spark):
    combos = list(product([False, True], repeat=4))
    rows = [tuple((BAD if v else GOOD)[m] for m, v in zip(GOOD, c)) for c in combos]
    got = scan.scan_by_rules(readings(spark, *rows)).orderBy("mote_id").collect()
    for violated, row in zip(combos, got):
        exact = 0.0
        for m, v in zip(GOOD, violated):
            exact += PENALTY[m] if v else 0.0
        exact = min(1.0, exact)
        assert row["anomaly_score"] == round(exact, 4)
        assert row["is_anomaly"] == (exact > 0.3)
        assert row["severity"] == (
            "critical" if exact >= 0.65 else "warning" if exact >= 0.5 else "normal"
        )


def test_rule_bounds(spark):
    inside = [(15.0, 20.0, 0.0, 2.0), (45.0, 90.0, 2000.0, 3.5)]
    outside = [(20.0, 50.0, -1.0, 2.9), (20.0, 50.0, 100.0, 1.9)]
    got = scan.scan_by_rules(readings(spark, *inside, *outside)).orderBy("mote_id").collect()
    assert [r["anomaly_score"] for r in got] == [0.0, 0.0, 0.2, 0.3]
    assert not any(r["is_anomaly"] for r in got)


def test_missing_metric_is_kept_unscored(spark):
    row = scan.scan_by_rules(readings(spark, (20.0, None, 100.0, None))).first()
    assert row["anomaly_score"] is None and row["severity"] is None
    assert row["unscored"] == "missing humidity, voltage"


def test_absent_column_gets_usual_value(spark):
    row = scan.scan_by_rules(readings(spark, (20.0, 50.0, 9.0, 1.0)).drop("voltage")).first()
    assert row["anomaly_score"] == 0.0 and row["voltage"] == 2.9


def test_physics_bounds(spark):
    edges = [(-10.0, 0.0, 0.0, 0.0), (80.0, 100.0, 3000.0, 5.0), (None, None, None, None)]
    beyond = [(80.1, 50.0, 1.0, 1.0), (1.0, -0.1, 1.0, 1.0), (1.0, 1.0, 3001.0, 1.0)]
    assert clean.within_physics(readings(spark, *edges, *beyond)).count() == 3


def test_model_score(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (0.2,), (2.0,), (None,)], "d double")
    got = [r[0] for r in df.select(scores.model_score(F.col("d"))).collect()]
    assert got == [1.0, 0.5, 0.4, 0.0, None]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "v double")
    bins = {r["bin"]: r["n"] for r in profile.histogram(df, "v").collect()}
    assert len(bins) == 50 and bins[50] == 3 and sum(bins.values()) == 101
    constant = spark.createDataFrame([(4.0,), (4.0,), (None,)], "v double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(constant, "v").collect()] == [(1, 2)]


def training(spark, n=3000):
    return (
        spark.range(n)
        .select(
            F.col("id").alias("row"),
            (22 + F.randn(1) * 2).alias("temperature"),
            (50 + F.randn(2) * 5).alias("humidity"),
            (300 + F.randn(3) * 80).alias("light"),
            (2.8 + F.randn(4) * 0.1).alias("voltage"),
            (F.col("id") % 24).cast("double").alias("hour"),
            (F.col("id") % 7).cast("double").alias("day_of_week"),
        )
        .coalesce(1)
        .persist()
    )


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    n, scale = features.scaling(df, ["a", "b"])
    assert n == 2 and scale == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert features.scaled(df, scale).collect()[0] == (-1.0, 0.0)


def test_features_of_one_row_group_come_in_bounded_files(spark, tmp_path):
    """The features of a table in one row group, with nulls and equal rows, are in files
    of bounded size, which scoring reads in as many tasks as it likes."""
    times = "timestamp_seconds(1700000000 + id * 977)"
    rows = spark.range(2000, numPartitions=1).selectExpr(
        "cast(id % 9 as int) as mote_id", f"{times} as timestamp", "id % 40 + 0.5D as temperature",
        "if(id % 7 = 0, null, id % 90 + 0D) as humidity", "id % 800 + 0D as light",
        "2.5D as voltage", "'a' as other",
    )
    equal = rows.limit(1).crossJoin(spark.range(500)).drop("id")
    rows.union(equal).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert len(one.inputFiles()) == 1
    got = features.prepare_features(one, ("mote_id", "timestamp"), rows_per_file=100)
    files = got.select("*", "_metadata.file_name").groupBy("file_name").count().collect()
    assert max(f["count"] for f in files) <= 100
    kept = ["mote_id", "timestamp", "temperature", "light", "voltage"]
    as_rows = lambda df: sorted(map(tuple, df.select(kept).collect()))
    assert as_rows(got) == as_rows(one)
    median = np.median([r[0] for r in one.select("humidity").dropna().collect()])
    filled = one.select(F.coalesce("humidity", F.lit(float(median)))).collect()
    assert sorted(r["humidity"] for r in got.collect()) == sorted(r[0] for r in filled)


def test_forest_is_independent_of_partitioning(spark):
    df = training(spark)
    one = forest.fit(df, key=["row"], n_trees=20)
    two = forest.fit(df.repartition(7), key=["row"], n_trees=20)
    assert np.allclose([tuple(n) for n in one.nodes], [tuple(n) for n in two.nodes])
    assert one.offset == pytest.approx(two.offset)


def test_forest_shape_and_share(spark):
    df = training(spark)
    trained, decided = forest.fit_scored(df, key=["row"])
    trees = {}
    for n in trained.nodes:
        trees.setdefault(n["tree"], []).append(n)
    assert len(trees) == 100
    for nodes in trees.values():
        leaves = [n for n in nodes if n["feature"] < 0]
        assert sum(n["size"] for n in leaves) == 256
        assert len(nodes) == 2 * len(leaves) - 1
        assert max(n["depth"] for n in nodes) <= 8
    flagged = decided.filter("decision < 0").count() / 3000
    assert abs(flagged - 0.05) < 0.002


def test_probes_stand_out(spark):
    trained = forest.fit(training(spark), key=["row"])
    probes = spark.createDataFrame(
        [
            (22.5, 55.0, 300.0, 2.9), (20.0, 60.0, 200.0, 3.0), (25.0, 50.0, 400.0, 2.8),
            (0.0, 0.0, 0.0, 0.0), (95.0, 2.0, 0.0, 0.1), (None, 1.0, 1.0, 1.0),
        ],
        "temperature double, humidity double, light double, voltage double",
    )
    got = scan.scan_by_model(probes, trained, as_of=datetime(2026, 1, 7, 12)).collect()
    by = [r["anomaly_score"] for r in got]
    assert max(by[:3]) < min(by[3:5])
    assert got[3]["is_anomaly"] and got[4]["is_anomaly"]
    assert by[5] is None and got[5]["unscored"] == "missing temperature"


def test_path_lengths_against_a_plain_walk(spark):
    trained = forest.fit(training(spark, 600), key=["row"], n_trees=5)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(50, 6)) * 2
    packed, depth = forest._packed(trained.nodes)
    fast = forest._path_lengths(packed, depth, list(points.T.copy()))
    table = {(n["tree"], n["node"]): n for n in trained.nodes}
    for point, length in zip(points, fast):
        total = 0.0
        for tree in range(5):
            n = table[tree, 0]
            while n["feature"] >= 0:
                side = "left" if point[n["feature"]] <= n["threshold"] else "right"
                n = table[tree, n[side]]
            total += n["depth"] + float(forest.mean_path(n["size"]))
        assert length == pytest.approx(total / 5)


def grown(n_trees, sample, limit, seed=0):
    """Trees over random rows as nodes, with the rows' distribution for more points."""
    rng, nodes = np.random.default_rng(seed), []
    for tree in range(n_trees):
        rows = forest._grow(rng.normal(size=(sample, 6)).round(2), rng, limit)
        names = ("feature", "threshold", "left", "right", "size", "depth")
        nodes += [{"tree": tree, "node": i, **dict(zip(names, r))} for i, r in enumerate(rows)]
    return nodes


def level_by_level(nodes, columns):
    """All points down every tree, a level at a time; sums from the first tree on."""
    total, points, n_trees = np.zeros(len(columns[0])), np.stack(columns), 0
    trees = {}
    for n in nodes:
        trees.setdefault(n["tree"], []).append(n)
    for rows in trees.values():
        feature, threshold, left = (
            np.array([n[c] for n in rows]) for c in ("feature", "threshold", "left")
        )
        path = np.array([n["depth"] for n in rows]) + forest.mean_path([n["size"] for n in rows])
        inner = feature >= 0
        left = np.where(inner, left, np.arange(len(rows)))
        feature, threshold = np.where(inner, feature, 0), np.where(inner, threshold, np.inf)
        at = np.zeros(points.shape[1], np.intp)
        for _ in range(max(n["depth"] for n in rows)):
            at = left[at] + (points[feature[at], np.arange(len(at))] > threshold[at])
        total += path[at]
        n_trees += 1
    return total / n_trees


@pytest.mark.parametrize(
    "n_trees, sample, limit", [(3, 1, 8), (1, 2, 1), (9, 40, 6), (30, 256, 8), (5, 700, 10), (2, 3000, 30)]
)
def test_path_lengths_of_odd_values(n_trees, sample, limit):
    """Values at a threshold, infinite or not numbers; trees of many leaves."""
    nodes = grown(n_trees, sample, limit)
    points = np.random.default_rng(1).normal(size=(6, 1000)).round(1)
    cuts = [n["threshold"] for n in nodes if n["feature"] >= 0] or [0.0]
    points[:, :400] = np.random.default_rng(2).choice(cuts, (6, 400))
    points[:, 400:406][np.diag_indices(6)] = np.nan
    points[:, 406:409] = np.array([np.inf, -np.inf, -0.0])
    packed, depth = forest._packed(nodes)
    got = forest._path_lengths(packed, depth, list(points))
    assert got.tolist() == level_by_level(nodes, list(points)).tolist()
    assert forest._path_lengths(packed, depth, [c[:0] for c in points]).tolist() == []
    assert forest._path_lengths(packed, depth, [c[:1] for c in points]).tolist() == got[:1].tolist()


def test_sets_of_leaves_stay_small():
    """The bits of few large trees do not grow with the square of all their leaves."""
    packed, _ = forest._packed(grown(6, 3000, 30))
    groups = forest._leaf_sets(packed)
    assert len(groups) > 1
    assert max(sum(left.nbytes for _, _, left in sets) for _, _, sets in groups) < 2 << 20


def test_scoring_takes_less_than_a_walk():
    nodes, points = grown(100, 256, 8), list(np.random.default_rng(1).normal(size=(6, 10_000)))
    packed, depth = forest._packed(nodes)
    groups = forest._leaf_sets(packed)
    spent = {}
    for name, run in (
        ("walk", lambda: level_by_level(nodes, points)),
        ("sets", lambda: forest._path_lengths(packed, depth, points, groups)),
    ):
        for _ in range(5):
            start = process_time()
            run()
            spent[name] = min(spent.get(name, np.inf), process_time() - start)
    assert spent["sets"] < 0.6 * spent["walk"]


def test_decisions_against_a_plain_walk(spark):
    """What a trained forest decides about each row, worked out node by node."""
    df = training(spark, 500)
    trained = forest.fit(df, key=["row"], n_trees=7)
    table = {(n["tree"], n["node"]): n for n in trained.nodes}
    got = forest.decide(df, trained).collect()
    means = {c: np.mean([r[c] for r in got]) for c in trained.columns}
    widths = {c: np.std([r[c] for r in got]) for c in trained.columns}
    for row in got[::5]:
        point = [(row[c] - means[c]) / widths[c] for c in trained.columns]
        total = 0.0
        for tree in range(7):
            n = table[tree, 0]
            while n["feature"] >= 0:
                side = "left" if point[n["feature"]] <= n["threshold"] else "right"
                n = table[tree, n[side]]
            total += n["depth"] + float(forest.mean_path(n["size"]))
        score = 2.0 ** (-total / 7 / float(forest.mean_path(trained.sample)))
        assert row["decision"] == pytest.approx(-score - trained.offset, abs=1e-9)
    flagged = sum(r["decision"] < 0 for r in got)
    assert flagged == 25  # five per cent of the rows it was trained on


def test_mean_path():
    assert list(forest.mean_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert forest.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_few_rows_use_all_of_them(spark):
    df = training(spark, 120)
    samples = forest.tree_samples(df.select("row", *FEATURES), 120, ["row"], sample=120)
    sizes = {r["tree"]: r["count"] for r in samples.groupBy("tree").count().collect()}
    assert len(sizes) == 100 and set(sizes.values()) == {120}


def test_versions(spark, tmp_path):
    base = str(tmp_path)
    df = training(spark, 400).withColumn("mote_id", F.lit(1))
    assert models.load_latest(spark, base) is None
    assert models.model_info(spark, base).first()["fallback_mode"]
    first, trained, _ = models.train(spark, base, df, ["row"], datetime(2026, 1, 1), n_trees=10)
    second, _, _ = models.train(spark, base, df, ["row"], datetime(2026, 1, 2), "x", n_trees=10)
    assert (first, second) == ("20260101_000000", "20260102_000000_x")
    info = models.model_info(spark, base).first()
    assert (info["n_models"], info["latest"], info["fallback_mode"]) == (2, second, False)
    loaded = models.load_model(spark, f"{base}/models/version={first}")
    assert loaded.offset == trained.offset and len(loaded.nodes) == len(trained.nodes)
    assert models.train(spark, base, df.limit(99), ["row"], datetime(2026, 1, 3)) is None
    assert models.registry(spark, base).count() == 2


def test_features(spark):
    df = spark.createDataFrame(
        [
            ("21.5", None, "100", "2.7", "2026-01-05T13:30:00"),
            ("bad", "40", "300", "NaN", "2026-01-06T01:00:00Z"),
            (None, None, None, None, "2026-01-06T01:00:00"),
            ("99", "40", "300", "2.7", "2026-01-06T01:00:00"),
        ],
        "temperature string, humidity string, light string, voltage string, "
        "updated_timestamp string",
    )
    got = features.prepare_features(df, keep=()).collect()
    assert [tuple(r) for r in got] == [
        (21.5, 40.0, 100.0, 2.7, 13.0, 0.0),
        (21.5, 40.0, 300.0, 2.7, 1.0, 1.0),
    ]
    untimed = features.prepare_features(df.drop("updated_timestamp"), keep=())
    assert {(r["hour"], r["day_of_week"]) for r in untimed.collect()} == {(12.0, 0.0)}


def test_seeded_sample(spark):
    df = spark.range(1000)

    def drawn(frame, n=50, **options):
        return sorted(r["id"] for r in features.seeded_sample(frame, n, ["id"], **options).collect())

    first = drawn(df)
    assert len(first) == len(set(first)) == 50
    assert first == drawn(df.repartition(5)) == drawn(df, rows_per_slice=9)
    assert first != drawn(df, seed=7)
    assert drawn(df, 2000) == list(range(1000))
    large = drawn(spark.range(20_000), 500)
    assert len(large) == 500 and 8000 < sum(large) / 500 < 12_000


def test_absent_metric_column(spark, tmp_path):
    df = training(spark, 400).drop("light")
    prepared = features.prepare_features(df, ("row",))
    assert "light" not in prepared.columns
    version, trained, _ = models.train(
        spark, str(tmp_path / "m"), df, ["row"], datetime(2026, 1, 1), n_trees=5
    )
    assert trained.columns == tuple(c for c in FEATURES if c != "light")
    with pytest.raises(ValueError):
        features.prepare_features(df.select("row"), ())
