"""Queries of features, rules, the forest and its versions."""

from datetime import datetime, timedelta

from pyspark.sql import Row
from pyspark.sql import functions as F

from sensorlake.functions import scores
from sensorlake.operators import clean, features, forest, models, scan, timeseries
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import sql
from sensorlake.schemas import FEATURES, METRICS, PHYSICS_BOUNDS, PROBES, RULES
from sensorlake.session import scratch_path
from sensorlake.sources import archive

_METRICS = ", ".join(METRICS)


def _double(value):
    return f"CAST({value} AS DOUBLE)"


_INSIDE = " AND ".join(
    f"({m} IS NULL OR {m} BETWEEN {_double(lo)} AND {_double(hi)})"
    for m, (lo, hi) in PHYSICS_BOUNDS.items()
)


def _prepared_sql(view, time):
    return f"""(SELECT mote_id, {_METRICS}, CAST(hour({time}) AS DOUBLE) AS hour,
      CAST(isodow({time}) - 1 AS DOUBLE) AS day_of_week FROM {view}
      WHERE coalesce({_METRICS}) IS NOT NULL AND {_INSIDE})"""


def _imputed_sql(view, time):
    source = _prepared_sql(view, time)
    columns = ", ".join(
        f"coalesce({c}, (SELECT median({c}) FROM {source})) AS {c}" for c in FEATURES
    )
    return f"(SELECT mote_id, {columns} FROM {source})"


_SPARSE = _imputed_sql("sparse", "updated_timestamp")
_DENSE = _prepared_sql("dense", '"timestamp"')


@query(
    "m1_features",
    sql(f"SELECT * FROM {_SPARSE}", "sparse"),
)
def prepared(spark, sf_dir):
    return features.prepare_features(tables.sparse(spark, sf_dir))


@query(
    "a22_medians",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM "
            + _prepared_sql("sparse", "updated_timestamp")
            for c in FEATURES
        ),
        "sparse",
    ),
)
def column_medians(spark, sf_dir):
    rows = clean.within_physics(
        features.time_features(clean.drop_empty(tables.sparse(spark, sf_dir)))
    )
    found = [(c, round(m, 6)) for c, m in features.medians(rows).items()]
    return spark.createDataFrame(found, "feature string, median double")


@query(
    "a23_scaling",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,
                coalesce(nullif(round(stddev_pop({c}), 6), 0), 1) AS std FROM {_DENSE}"""
            for c in FEATURES
        ),
        "dense",
    ),
)
def scaling(spark, sf_dir):
    _, scale = features.scaling(features.prepare_features(tables.dense(spark, sf_dir)))
    found = [(c, round(mean, 6), round(std, 6)) for c, (mean, std) in scale.items()]
    return spark.createDataFrame(found, "feature string, mean double, std double")


@query(
    "m2_scaled",
    sql(
        "SELECT mote_id, "
        + ", ".join(
            f"""round(({c} - (SELECT avg({c}) FROM {_DENSE}))
                / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM {_DENSE}), 4) + 0 AS {c}"""
            for c in FEATURES
        )
        + f" FROM {_DENSE}",
        "dense",
    ),
)
def scaled(spark, sf_dir):
    rows = features.prepare_features(tables.dense(spark, sf_dir))
    _, scale = features.scaling(rows)
    return features.scaled(rows, scale).select(
        "mote_id", *[(F.round(c, 4) + 0).alias(c) for c in FEATURES]
    )


def _rule_sql(source, columns):
    score = " + ".join(
        f"""CASE WHEN NOT {m} BETWEEN {_double(lo)} AND {_double(hi)} THEN {_double(p)}
            WHEN {m} IS NOT NULL THEN {_double(0)} END"""
        for m, (lo, hi, p) in RULES.items()
    )
    missing = " || ".join(f"CASE WHEN {m} IS NULL THEN ', {m}' ELSE '' END" for m in METRICS)
    return f"""SELECT {columns}, round(s, 4) AS anomaly_score, s > {_double(0.3)} AS is_anomaly,
        CASE WHEN s >= {_double(0.65)} THEN 'critical' WHEN s >= {_double(0.5)} THEN 'warning'
             WHEN s IS NOT NULL THEN 'normal' END AS severity,
        CASE WHEN ({missing}) <> '' THEN 'missing ' || substr({missing}, 3) END AS unscored
        FROM (SELECT *, CASE WHEN x IS NOT NULL THEN least({_double(1)}, x) END AS s
              FROM (SELECT *, {_double(0)} + {score} AS x FROM {source}))"""


_ROW = f'mote_id, "timestamp", {_METRICS}'


@query("m7_rule_scores", sql(_rule_sql("dense", _ROW), "dense"))
def rule_scores(spark, sf_dir):
    return scan.scan_by_rules(tables.dense(spark, sf_dir))


@query(
    "m7_rule_scores_with_nulls",
    sql(_rule_sql("complete", f"epoch, {_METRICS}"), "complete"),
)
def rule_scores_with_nulls(spark, sf_dir):
    rows = tables.complete(spark, sf_dir, motes=None).select("epoch", *METRICS)
    return scan.scan_by_rules(rows)


@query(
    "f13_model_score",
    """SELECT event_id, least(greatest(CAST(0.5 AS DOUBLE) - (value / 100 - 1) / 2, 0), 1) AS score
       FROM events""",
)
def model_score(spark, sf_dir):
    return tables.table(spark, sf_dir, "events").select(
        "event_id", scores.model_score(F.col("value") / 100 - 1).alias("score")
    )


@query(
    "f14_severity",
    """SELECT severity, count(*) AS n FROM (SELECT CASE WHEN value / 100 >= CAST(0.65 AS DOUBLE)
         THEN 'critical' WHEN value / 100 >= CAST(0.5 AS DOUBLE) THEN 'warning' ELSE 'normal' END
         AS severity FROM events) GROUP BY 1""",
)
def severity(spark, sf_dir):
    label = scores.severity(F.col("value") / 100)
    events = tables.table(spark, sf_dir, "events")
    return events.groupBy(label.alias("severity")).agg(F.count(F.lit(1)).alias("n"))


_WIDE = ", ".join(f"max(CASE WHEN f = '{m}' THEN v END) AS {m}" for m in METRICS)
_LATEST = (
    f"(SELECT t, mote_id, {_WIDE} FROM (SELECT mote_id, f, max(t) AS t, arg_max(v, t) AS v FROM ("
    + " UNION ALL ".join(
        f"""SELECT mote_id, '{m}' AS f, "timestamp" AS t, {m} AS v FROM complete, clock
            WHERE {m} IS NOT NULL AND "timestamp" >= as_of - INTERVAL 7 DAY
              AND "timestamp" < as_of"""
        for m in METRICS
    )
    + ") GROUP BY 1, 2) GROUP BY 1, 2)"
)


def _latest(spark, sf_dir):
    points = timeseries.to_points(tables.complete(spark, sf_dir, motes=None), "timestamp")
    return timeseries.latest_points(points, tables.event_clock(spark, sf_dir), "-7d")


_SCAN_COLUMNS = f"CAST(mote_id AS VARCHAR) AS mote_id, t AS _time, {_METRICS}"


@query(
    "m8_rule_scan",
    sql(_rule_sql(_LATEST, _SCAN_COLUMNS), "complete", "clock"),
)
def rule_scan(spark, sf_dir):
    return scan.scan_by_rules(_latest(spark, sf_dir))


@query(
    "a21_scan_summary",
    sql(
        f"""SELECT count(anomaly_score) AS n_scanned, count(*) FILTER (is_anomaly) AS n_anomalies,
            count(*) FILTER (is_anomaly) / greatest(count(anomaly_score), 1) AS anomaly_rate
            FROM ({_rule_sql(_LATEST, _SCAN_COLUMNS)})""",
        "complete",
        "clock",
    ),
)
def scan_summary(spark, sf_dir):
    return scan.scan_summary(scan.scan_by_rules(_latest(spark, sf_dir)))


@query(
    "l5_by_score",
    sql(
        f"""SELECT * FROM ({_rule_sql('complete', f'epoch, {_METRICS}')})
            WHERE is_anomaly ORDER BY anomaly_score DESC, epoch""",
        "complete",
    ),
)
def by_score(spark, sf_dir):
    rows = tables.complete(spark, sf_dir, motes=None).select("epoch", *METRICS)
    return scan.by_score(scan.scan_by_rules(rows), only_anomalies=True, ties=("epoch",))


# A forest draws at random, so scores are compared under a small one that is written out
# here: per tree its nodes as feature, threshold and both sides, or the size of a leaf.
_TREES = (
    ("temperature", 0.5, 120, ("voltage", -0.2, 100, 36)),
    ("humidity", 0.1, ("day_of_week", 0.3, 60, 2), 194),
)
_SMALL_SAMPLE, _SMALL_OFFSET = 256, -0.48


def _nodes(tree, root):
    """Rows of the node table, breadth first."""
    waiting, rows = [(root, 0)], []
    while len(rows) < len(waiting):
        node, depth = waiting[len(rows)]
        if isinstance(node, int):
            rows.append((tree, len(rows), -1, 0.0, -1, -1, node, depth))
            continue
        left = len(waiting)
        waiting += [(node[2], depth + 1), (node[3], depth + 1)]
        at = FEATURES.index(node[0])
        rows.append((tree, len(rows), at, node[1], left, left + 1, 0, depth))
    names = Row("tree", "node", "feature", "threshold", "left", "right", "size", "depth")
    return [names(*r) for r in rows]


def _small_forest(spark, sf_dir, offset=_SMALL_OFFSET):
    _, scale = features.scaling(_features(spark, sf_dir))
    nodes = tuple(n for t, root in enumerate(_TREES) for n in _nodes(t, root))
    return forest.Forest(nodes, scale, offset, _SMALL_SAMPLE)


def _mean_path_sql(n):
    return "1" if n == 2 else f"(2 * (ln({_double(n - 1)}) + 0.5772156649015329) - {_double(2 * (n - 1))} / {n})"


def _path_sql(node, depth=0):
    if isinstance(node, int):
        return f"({depth} + {_mean_path_sql(node)})"
    feature, at, low, high = node
    return f"""(CASE WHEN z_{feature} > {_double(at)} THEN {_path_sql(high, depth + 1)}
        ELSE {_path_sql(low, depth + 1)} END)"""


_SCALE = (
    "(SELECT "
    + ", ".join(
        f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in FEATURES
    )
    + f" FROM {_DENSE})"
)
_SUM = " + ".join(_path_sql(root) for root in _TREES)
_SMALL_SCORE = f"pow({_double(2)}, -(({_SUM}) / {len(_TREES)}) / {_mean_path_sql(_SMALL_SAMPLE)})"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)


def _decided_sql(source, offset=_SMALL_OFFSET):
    """All columns of the source and the decision of the small forest."""
    scaled_ = ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in FEATURES)
    return f"""(SELECT * EXCLUDE ({', '.join(f'm_{c}, s_{c}, z_{c}' for c in FEATURES)}),
        CASE WHEN {_COMPLETE} THEN -{_SMALL_SCORE} - {_double(offset)} END AS decision
        FROM (SELECT *, {scaled_} FROM {source}, {_SCALE}))"""


def _predicted_sql(source, columns):
    return f"""SELECT {columns}, round(s, 4) AS anomaly_score, decision < 0 AS is_anomaly,
        CASE WHEN s >= {_double(0.65)} THEN 'critical' WHEN s >= {_double(0.5)} THEN 'warning'
             WHEN s IS NOT NULL THEN 'normal' END AS severity
        FROM (SELECT *, CASE WHEN decision IS NOT NULL THEN
                least(greatest({_double(0.5)} - decision / 2, 0), 1) END AS s
              FROM {_decided_sql(source)})"""


_KEY = ("mote_id", "timestamp", *METRICS)
_ALL = f"mote_id, {', '.join(FEATURES)}"


def _features(spark, sf_dir):
    return features.prepare_features(tables.dense(spark, sf_dir), ("mote_id", "timestamp"))


@query(
    "m3_forest_nodes",
    sql(
        f"""SELECT CAST(tree AS INTEGER) AS tree, least(256, n) AS n_root,
            CAST(least(256, n) AS BIGINT) AS n_in_leaves, true AS shallow
            FROM range(100) t(tree), (SELECT count(*) AS n FROM {_DENSE})""",
        "dense",
    ),
)
def forest_nodes(spark, sf_dir):
    """Every tree holds its whole sample in leaves that are not too deep."""
    trained = forest.fit(_features(spark, sf_dir), _KEY)
    nodes = spark.createDataFrame(list(trained.nodes), forest.NODES)
    leaf = F.when(F.col("feature") < 0, F.col("size"))
    return nodes.groupBy("tree").agg(
        F.max("size").alias("n_root"),
        F.sum(leaf).alias("n_in_leaves"),
        (F.max("depth") <= 8).alias("shallow"),
    )


@query(
    "m4_forest_decisions",
    sql(f"SELECT {_ALL}, round(decision, 9) AS decision FROM {_decided_sql(_DENSE)}", "dense"),
)
def forest_decisions(spark, sf_dir):
    decided = forest.decide(_features(spark, sf_dir), _small_forest(spark, sf_dir))
    return decided.select("mote_id", *FEATURES, F.round("decision", 9).alias("decision"))


@query("m6_forest_scores", sql(_predicted_sql(_DENSE, _ALL), "dense"))
def forest_scores(spark, sf_dir):
    found = forest.predict(_features(spark, sf_dir), _small_forest(spark, sf_dir))
    return found.drop("timestamp", "decision")


@query("m6_trained_scores")
def trained_scores(spark, sf_dir):
    """Train 100 trees on the table and return score, flag and severity of every row; the
    tests compare decisions with a plain walk through the nodes."""
    features = _features(spark, sf_dir)
    found = forest.predict(features, forest.fit(features, _KEY))
    return found.select(*_KEY, "decision", "anomaly_score", "is_anomaly", "severity")


@query(
    "m5_contamination",
    sql(
        f"""SELECT c AS contamination, (SELECT count(*) FROM {_decided_sql(_DENSE, 0)}
              WHERE decision < (SELECT quantile_cont(decision, c) FROM {_decided_sql(_DENSE, 0)}))
              AS n_flagged
            FROM (VALUES (CAST(0.05 AS DOUBLE)), (CAST(0.4 AS DOUBLE))) v(c)""".replace(
            "quantile_cont(decision, c)",
            "CASE WHEN c < 0.1 THEN quantile_cont(decision, 0.05) ELSE quantile_cont(decision, 0.4) END",
        ),
        "dense",
    ),
)
def contamination(spark, sf_dir):
    """Rows flagged when the threshold is the quantile of the scores."""
    rows, small = _features(spark, sf_dir), _small_forest(spark, sf_dir)
    found = []
    for share in (0.05, 0.4):
        _, decided = forest.with_threshold(small, features.scaled(rows, small.scale), share)
        found.append(
            decided.agg(F.count_if(F.col("decision") < 0).alias("n_flagged")).select(
                F.lit(share).alias("contamination"), "n_flagged"
            )
        )
    return found[0].unionByName(found[1])


_WHEN = datetime(2026, 3, 1, 12, 30, 15)


def _metrics_of_small(spark, sf_dir):
    small = _small_forest(spark, sf_dir)
    decided = forest.decide(_features(spark, sf_dir), small)
    return forest.training_metrics(decided, small, n_trees=len(_TREES))


@query(
    "m9_training_metrics",
    sql(
        f"""SELECT count(*) AS n_samples, 6 AS n_features, CAST(0.05 AS DOUBLE) AS contamination,
            2 AS n_estimators, count(*) FILTER (decision < 0) AS n_anomalies_detected
            FROM {_decided_sql(_DENSE)}""",
        "dense",
    ),
)
def training_metrics(spark, sf_dir):
    return _metrics_of_small(spark, sf_dir).select(
        "n_samples", "n_features", "contamination", "n_estimators", "n_anomalies_detected"
    )


@query(
    "a24_decision_stats",
    sql(
        f"""SELECT round(avg(decision), 4) AS score_mean, round(stddev_pop(decision), 4) AS score_std,
            round(count(*) FILTER (decision < 0) / count(*), 4) AS anomaly_ratio
            FROM {_decided_sql(_DENSE)}""",
        "dense",
    ),
)
def decision_stats(spark, sf_dir):
    return _metrics_of_small(spark, sf_dir).select("score_mean", "score_std", "anomaly_ratio")


@query(
    "m10_model_registry",
    sql(
        f"""SELECT version, n_samples, latest, true AS near FROM (VALUES ('20260301_123015', false),
              ('20260302_123015_manual', true)) v(version, latest),
            (SELECT count(*) AS n_samples FROM {_DENSE}) n""",
        "dense",
    ),
)
def model_registry(spark, sf_dir):
    """Two versions are trained, saved and listed; the later one is the latest, and each
    flags the share of its training rows that was asked for."""
    base = scratch_path(spark, "models")
    rows = tables.dense(spark, sf_dir)
    models.train(spark, base, rows, _KEY, _WHEN)
    models.train(spark, base, rows, _KEY, _WHEN + timedelta(days=1), tag="manual")
    listed = models.registry(spark, base)
    newest = models.latest_entry(listed).select("version").scalar()
    return listed.select(
        "version",
        "n_samples",
        (F.col("version") == newest).alias("latest"),
        (F.abs(F.col("anomaly_ratio") - 0.05) < 0.005).alias("near"),
    )


def _saved(spark, sf_dir):
    """The small forest, saved and loaded again."""
    base = scratch_path(spark, "models")
    small, metrics = _small_forest(spark, sf_dir), _metrics_of_small(spark, sf_dir).first()
    models.save_model(spark, base, small, metrics, _WHEN)
    return models.load_latest(spark, base)


def _timed(source, time):
    return f"""(SELECT *, CAST(hour({time}) AS DOUBLE) AS hour,
        CAST(isodow({time}) - 1 AS DOUBLE) AS day_of_week FROM {source})"""


_REASON = (
    "CASE WHEN NOT (" + " AND ".join(f"{m} IS NOT NULL" for m in METRICS) + ") THEN 'missing ' || "
    + "concat_ws(', ', " + ", ".join(f"CASE WHEN {m} IS NULL THEN '{m}' END" for m in METRICS)
    + ") END AS unscored"
)


@query(
    "m8_model_scan",
    sql(_predicted_sql(_timed(_LATEST, "t"), f"{_SCAN_COLUMNS}, {_REASON}"), "complete", "clock", "dense"),
)
def model_scan(spark, sf_dir):
    """The newest readings scored by a saved model."""
    rows = _latest(spark, sf_dir).withColumn("timestamp", F.col("_time"))
    found = scan.scan(rows, _saved(spark, sf_dir))
    return found.drop("timestamp", "hour", "day_of_week")


@query(
    "m8_model_scores",
    sql(_predicted_sql(_timed("complete", '"timestamp"'), f"epoch, {_METRICS}, {_REASON}"), "complete", "dense"),
)
def model_scores(spark, sf_dir):
    """All readings, with their gaps, scored by a saved model."""
    rows = tables.complete(spark, sf_dir, motes=None).select("epoch", "timestamp", *METRICS)
    found = scan.scan(rows, _saved(spark, sf_dir))
    return found.drop("timestamp", "hour", "day_of_week")


@query(
    "m11_retrain",
    f"""SELECT count(*) AS n_samples, 'scheduled' AS tag FROM (SELECT * FROM
          ({tables.SQL_COMPLETE}) WHERE CAST(updated_timestamp AS DATE) > (SELECT
            CAST(max(ts) + INTERVAL {tables.MOVED.days} DAY AS DATE) - 3 FROM events))
        WHERE coalesce({_METRICS}) IS NOT NULL AND {_INSIDE} HAVING count(*) >= 100""",
)
def retrain(spark, sf_dir):
    """The scheduled job over the archive's last three days; too few rows train nothing."""
    path, base = scratch_path(spark, "archive"), scratch_path(spark, "models")
    archive.write_mote_archive(tables.complete(spark, sf_dir), path)
    rows = archive.read_mote_archive(spark, path)
    clock = tables.moved_clock(spark, sf_dir)
    models.retrain(spark, base, rows, clock, ("mote_id", "epoch"))
    return models.registry(spark, base).select("n_samples", "tag")


_PROBE_ROWS = ", ".join(
    f"('{name}', " + ", ".join(_double(v) for v in values) + ")" for name, *values in PROBES
)
_PROBED = _timed(f"(VALUES {_PROBE_ROWS}) p(probe, {_METRICS}), dense_clock", "as_of")


@query("m12_probes", sql(_predicted_sql(_PROBED, "probe"), "dense", "dense_clock"))
def probes(spark, sf_dir):
    """Scores of the probe readings under a forest that is scaled by the readings."""
    rows = spark.createDataFrame(
        list(PROBES), "probe string, temperature double, humidity double, light double, voltage double"
    )
    clock = tables.dense_clock(spark, sf_dir)
    found = scan.scan_by_model(rows, _small_forest(spark, sf_dir), as_of=clock)
    return found.select("probe", "anomaly_score", "is_anomaly", "severity")
