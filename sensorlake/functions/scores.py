"""Columns for anomaly scores."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from sensorlake.schemas import METRICS, RULE_ALARM, RULES, SEVERITY


def clip(value, low=0.0, high=1.0):
    """The value within bounds; null stays null, which ``least`` alone would skip."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def severity(score):
    """Label of an unrounded score."""
    (top, top_limit), (middle, middle_limit) = SEVERITY
    return (
        F.when(score >= top_limit, top).when(score >= middle_limit, middle).otherwise("normal")
    )


def rule_score(columns=None):
    """Sum of penalties for metrics outside their limits, at most 1.

    Penalties are added in the order of the metrics, because double addition in
    another order would give other last digits. A null metric gives a null score.
    """
    columns = columns or {m: F.col(m) for m in METRICS}
    penalties = [
        F.when(~columns[m].between(low, high), penalty).when(columns[m].isNotNull(), 0.0)
        for m, (low, high, penalty) in RULES.items()
    ]
    return clip(reduce(add, penalties, F.lit(0.0)))


def rule_alarm(score):
    return score > RULE_ALARM


def model_score(decision):
    """A decision value (negative is anomalous) as a score in [0, 1]."""
    return clip(0.5 - decision / 2.0)
