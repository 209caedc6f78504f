"""Anomaly scan of readings, by rules or by model."""

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.functions.scores import rule_alarm, rule_score, severity
from sensorlake.operators.features import time_features
from sensorlake.operators.forest import predict
from sensorlake.schemas import METRICS, USUAL


def with_default_metrics(readings):
    """Add a metric column that is absent altogether with its usual value."""
    absent = {m: F.lit(v) for m, v in USUAL.items() if m not in readings.columns}
    return readings.withColumns(absent) if absent else readings


def _reason():
    missing = F.concat_ws(", ", *[F.when(F.col(m).isNull(), F.lit(m)) for m in METRICS])
    return F.when(missing != "", F.concat(F.lit("missing "), missing))


def scan_by_rules(readings):
    """Score, flag and severity by limits. A row that lacks a metric stays, unscored,
    with the reason."""
    score = rule_score()
    return with_default_metrics(readings).withColumns(
        {
            "anomaly_score": F.round(score, 4),
            "is_anomaly": rule_alarm(score),
            "severity": F.when(score.isNotNull(), severity(score)),
            "unscored": _reason(),
        }
    )


def scan_by_model(readings, forest, as_of=None):
    """Score, flag and severity by the forest.

    Hour and weekday come from the reading's own time, as in training; ``as_of``
    takes them from that moment instead.
    """
    rows = with_default_metrics(readings)
    if as_of is None:
        rows = time_features(rows)
    else:
        now = times.at(as_of)
        rows = rows.withColumns(
            {
                "hour": F.hour(now).cast("double"),
                "day_of_week": times.day_of_week(now).cast("double"),
            }
        )
    return predict(rows, forest).drop("decision").withColumn("unscored", _reason())


def scan(readings, forest=None, as_of=None):
    """By model when there is one, else by rules."""
    return scan_by_rules(readings) if forest is None else scan_by_model(readings, forest, as_of)


def scan_summary(scanned):
    """Rows scanned, anomalies and their rate; nothing scanned gives rate 0."""
    n = F.count("anomaly_score")
    anomalies = F.count_if("is_anomaly")
    return scanned.agg(
        n.alias("n_scanned"),
        anomalies.alias("n_anomalies"),
        (anomalies / F.greatest(n, F.lit(1))).alias("anomaly_rate"),
    )


def by_score(scanned, only_anomalies=False, ties=("mote_id",)):
    """Highest scores first."""
    rows = scanned.filter("is_anomaly") if only_anomalies else scanned
    return rows.orderBy(F.desc("anomaly_score"), *ties)
