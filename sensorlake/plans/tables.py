"""Sensor views over the given tables, the same in Spark and in SQL.

``events`` is a long table already: one value per user, kind and time. ``lineitem``
supplies readings with all four metrics.
"""

from datetime import timedelta

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.schemas import MEASUREMENT, METRICS

# Which kind of event stands for which metric, and how far recorded
# times are moved.
FIELDS = {"click": "temperature", "view": "humidity", "purchase": "light", "signup": "voltage"}
MOVED = timedelta(days=731)
MOTES = 6


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _field(column):
    field = F.when(F.lit(False), column)
    for kind, metric in FIELDS.items():
        field = field.when(column == kind, metric)
    return field.otherwise(column)


def points(spark, sf_dir):
    """Long points; ``error`` events stay as an unknown field."""
    return table(spark, sf_dir, "events").select(
        F.lit(MEASUREMENT).alias("measurement"),
        F.col("user_id").cast("string").alias("mote_id"),
        _field(F.col("event_type")).alias("_field"),
        F.col("value").alias("_value"),
        F.col("ts").alias("_time"),
        "event_id",
    )


def sparse(spark, sf_dir, motes=None):
    """Wide readings with mostly one metric each; ``motes`` folds the ids to so many."""
    mote = F.col("user_id") if motes is None else F.col("user_id") % motes + 1
    events = table(spark, sf_dir, "events").select(
        mote.cast("int").alias("mote_id"),
        F.col("ts").alias("timestamp"),
        _field(F.col("event_type")).alias("_field"),
        F.col("value").alias("_value"),
        "event_id",
    )
    return events.groupBy("mote_id", "timestamp").agg(
        F.min("event_id").alias("epoch"),
        (F.min("timestamp") + F.expr(f"interval {MOVED.days} days")).alias("updated_timestamp"),
        *[F.max(F.when(F.col("_field") == m, F.col("_value"))).alias(m) for m in METRICS],
    )


def dense(spark, sf_dir):
    """Readings with all four metrics; adding 0.0 turns a negative zero into zero."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("mote_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("temperature"),
        (F.col("l_extendedprice") / 1050.0).alias("humidity"),
        (F.col("l_extendedprice") / 40.0).alias("light"),
        (2.0 + 20.0 * (F.col("l_tax") + 0.0)).alias("voltage"),
    )


def complete(spark, sf_dir, motes=MOTES):
    """One reading per event, mostly with all four metrics, over few motes or all."""
    e = F.col("event_id")
    mote = F.col("user_id") if motes is None else F.col("user_id") % motes + 1
    return table(spark, sf_dir, "events").select(
        mote.cast("int").alias("mote_id"),
        e.alias("epoch"),
        F.col("ts").alias("timestamp"),
        (F.col("ts") + F.expr(f"interval {MOVED.days} days")).alias("updated_timestamp"),
        F.when(e % 17 > 0, F.col("value")).alias("temperature"),
        F.when(e % 19 > 0, (e % 101).cast("double")).alias("humidity"),
        F.when(e % 23 > 0, (e % 2500).cast("double")).alias("light"),
        F.when(e % 29 > 0, 2.0 + (e % 15) / 10.0).alias("voltage"),
    )


def locations(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("mote_id"),
        F.col("s_nationkey").cast("double").alias("x"),
        F.col("s_acctbal").alias("y"),
    )


def event_clock(spark, sf_dir):
    return times.latest_time(table(spark, sf_dir, "events"), "ts")


def moved_clock(spark, sf_dir):
    return event_clock(spark, sf_dir) + MOVED


def dense_clock(spark, sf_dir):
    return times.latest_time(table(spark, sf_dir, "lineitem"), "l_shipdate")


def _text(column):
    return column.cast("string")


def lines(spark, sf_dir, motes=None):
    """Sensor text with every defect the parsers know, one line per event; ``motes``
    folds the ids to so many."""
    user = F.col("user_id") if motes is None else F.col("user_id") % motes + 1
    e = F.col("event_id")

    def each(n):
        return e % n == 0

    ts = F.col("ts")
    odd = F.floor(e / 83) % 4
    bad_mote = (
        F.when(odd == 0, "abc").when(odd == 1, "65333").when(odd == 2, "0").otherwise("7.0")
    )
    date = F.date_format(ts, "yyyy-MM-dd")
    time = F.when(each(73), F.date_format(ts, "HH:mm:ss")).otherwise(
        F.date_format(ts, "HH:mm:ss.SSSSSS")
    )
    mote = F.when(each(83), bad_mote).otherwise(_text(user))
    temperature = (
        F.when(each(79), "19.x").when(each(67), "NaN").when(each(61), "?")
        .otherwise(_text(F.col("value")))
    )
    humidity = F.when(each(17), "?").otherwise(_text(e % 101))
    light = F.when(each(19), "?").otherwise(_text(e % 2500))
    voltage = F.when(each(13), "?").otherwise(F.concat(F.lit("2."), _text(e % 10)))
    moved = times.iso_text(ts + F.expr(f"interval {MOVED.days} days"))
    updated = (
        F.when(each(47), "garbage")
        .when(each(53), F.concat(moved, F.lit("+02:00")))
        .when(each(59), F.concat(moved, F.lit("Z")))
        .otherwise(moved)
    )
    full = [date, time, _text(e), mote, temperature, humidity, light, voltage, updated]
    line = (
        F.when(each(89), F.concat_ws(" ", date, time, mote, updated))
        .when(each(97), F.concat_ws(" ", *full[:6], voltage, updated))
        .when(each(71), F.concat_ws(" ", *full, F.lit("extra")))
        .when(each(43), F.concat(F.lit("  "), F.concat_ws(" \t", *full), F.lit(" ")))
        .otherwise(F.concat_ws(" ", *full))
    )
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"))


# The same views in SQL -------------------------------------------------------

_SQL_FIELD = (
    "CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in FIELDS.items())
    + " ELSE event_type END"
)


def _sql_wide(field="_field", value="_value"):
    return ", ".join(f"max(CASE WHEN {field} = '{m}' THEN {value} END) AS {m}" for m in METRICS)


def _sql_sparse(mote):
    return f"""
    SELECT CAST({mote} AS INTEGER) AS mote_id, ts AS "timestamp", min(event_id) AS epoch,
           ts + INTERVAL {MOVED.days} DAY AS updated_timestamp,
           {_sql_wide(_SQL_FIELD, "value")}
    FROM events GROUP BY 1, 2, 4"""


def _sql_lines(user):
    return f"""
    SELECT event_id,
      CASE WHEN event_id % 89 = 0 THEN concat_ws(' ', d, t, mote, upd)
           WHEN event_id % 97 = 0 THEN concat_ws(' ', d, t, epoch, mote, temp, hum, volt, upd)
           WHEN event_id % 71 = 0
             THEN concat_ws(' ', d, t, epoch, mote, temp, hum, light, volt, upd, 'extra')
           WHEN event_id % 43 = 0 THEN '  ' ||
             concat_ws(' ' || chr(9), d, t, epoch, mote, temp, hum, light, volt, upd) || ' '
           ELSE concat_ws(' ', d, t, epoch, mote, temp, hum, light, volt, upd) END AS line
    FROM (SELECT event_id, strftime(ts, '%Y-%m-%d') AS d,
        CASE WHEN event_id % 73 = 0 THEN strftime(ts, '%H:%M:%S')
             ELSE strftime(ts, '%H:%M:%S.%f') END AS t,
        CAST(event_id AS VARCHAR) AS epoch,
        CASE WHEN event_id % 83 <> 0 THEN CAST({user} AS VARCHAR)
             WHEN (event_id // 83) % 4 = 0 THEN 'abc' WHEN (event_id // 83) % 4 = 1 THEN '65333'
             WHEN (event_id // 83) % 4 = 2 THEN '0' ELSE '7.0' END AS mote,
        CASE WHEN event_id % 79 = 0 THEN '19.x' WHEN event_id % 67 = 0 THEN 'NaN'
             WHEN event_id % 61 = 0 THEN '?' ELSE CAST(value AS VARCHAR) END AS temp,
        CASE WHEN event_id % 17 = 0 THEN '?' ELSE CAST(event_id % 101 AS VARCHAR) END AS hum,
        CASE WHEN event_id % 19 = 0 THEN '?' ELSE CAST(event_id % 2500 AS VARCHAR) END AS light,
        CASE WHEN event_id % 13 = 0 THEN '?'
             ELSE '2.' || CAST(event_id % 10 AS VARCHAR) END AS volt,
        CASE WHEN event_id % 47 = 0 THEN 'garbage'
             WHEN event_id % 53 = 0 THEN moved || '+02:00'
             WHEN event_id % 59 = 0 THEN moved || 'Z' ELSE moved END AS upd
      FROM (SELECT *, strftime(ts + INTERVAL {MOVED.days} DAY, '%Y-%m-%dT%H:%M:%S.%f') AS moved
            FROM events))"""


def _sql_complete(mote):
    return f"""
    SELECT CAST({mote} AS INTEGER) AS mote_id, event_id AS epoch,
      ts AS "timestamp", ts + INTERVAL {MOVED.days} DAY AS updated_timestamp,
      CASE WHEN event_id % 17 > 0 THEN value END AS temperature,
      CASE WHEN event_id % 19 > 0 THEN CAST(event_id % 101 AS DOUBLE) END AS humidity,
      CASE WHEN event_id % 23 > 0 THEN CAST(event_id % 2500 AS DOUBLE) END AS light,
      CASE WHEN event_id % 29 > 0
        THEN CAST(2 AS DOUBLE) + (event_id % 15) / CAST(10 AS DOUBLE) END AS voltage
    FROM events"""


SQL_COMPLETE = _sql_complete(f"user_id % {MOTES} + 1")

VIEWS = {
    "points": f"""
    SELECT '{MEASUREMENT}' AS measurement, CAST(user_id AS VARCHAR) AS mote_id,
           {_SQL_FIELD} AS _field, value AS _value, ts AS _time, event_id FROM events""",
    "sparse": _sql_sparse("user_id"),
    "folded": _sql_sparse(f"user_id % {MOTES} + 1"),
    "dense": """
    SELECT CAST(l_suppkey AS INTEGER) AS mote_id, l_shipdate AS "timestamp",
           l_quantity AS temperature, l_extendedprice / CAST(1050 AS DOUBLE) AS humidity,
           l_extendedprice / CAST(40 AS DOUBLE) AS light,
           CAST(2 AS DOUBLE) + CAST(20 AS DOUBLE) * (l_tax + CAST(0 AS DOUBLE)) AS voltage
    FROM lineitem""",
    "complete": _sql_complete("user_id"),
    "clock": "SELECT max(ts) + INTERVAL 1 MICROSECOND AS as_of FROM events",
    "dense_clock": "SELECT max(l_shipdate) + INTERVAL 1 MICROSECOND AS as_of FROM lineitem",
    "lines": _sql_lines("user_id"),
    "folded_lines": _sql_lines(f"(user_id % {MOTES} + 1)"),
}


def sql(body, *views):
    """A statement with the named views in front."""
    return "WITH " + ", ".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" + body


def sql_number(token, nulls=()):
    """A token as double, null for a null mark or text that is no number."""
    keep = "".join(f" AND {token} <> '{n}'" for n in nulls)
    pattern = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    return f"CASE WHEN regexp_matches({token}, '{pattern}'){keep} THEN TRY_CAST({token} AS DOUBLE) END"


def sql_recorded(date, time):
    pattern = r"^\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$"
    return (
        f"CASE WHEN regexp_matches({time}, '{pattern}') "
        f"THEN TRY_CAST({date} || ' ' || {time} AS TIMESTAMP) END"
    )


def sql_iso(token, convert=True):
    """ISO text as timestamp; only the offsets the lines hold are converted."""
    plain = rf"TRY_CAST(regexp_replace({token}, '(Z|\+\d\d:\d\d)$', '') AS TIMESTAMP)"
    if not convert:
        return plain
    return f"CASE WHEN {token} LIKE '%+02:00' THEN {plain} - INTERVAL 2 HOUR ELSE {plain} END"
