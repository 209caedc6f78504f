"""Queries of imputation, replay and time remapping."""

from datetime import datetime

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators import clean, dedup, remap
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import sql
from sensorlake.session import scratch_path
from sensorlake.streaming import messages

_AS_OF = datetime(2026, 2, 10, 8, 30)
_SQL_AS_OF = "TIMESTAMP '2026-02-10 08:30:00'"
_FORWARD = """(SELECT *, last_value(voltage IGNORE NULLS) OVER (PARTITION BY mote_id
    ORDER BY "timestamp", epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward
    FROM sparse)"""


@query(
    "w1_forward_fill",
    sql(f"""SELECT mote_id, "timestamp", forward AS voltage FROM {_FORWARD}""", "sparse"),
)
def forward_fill(spark, sf_dir):
    rows = clean.forward_fill_voltage(tables.sparse(spark, sf_dir))
    return rows.select("mote_id", "timestamp", "voltage")


@query(
    "w2_back_fill",
    sql(
        f"""SELECT mote_id, "timestamp", coalesce(forward, first_value(forward IGNORE NULLS) OVER
            (ORDER BY mote_id, "timestamp", epoch ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
            AS voltage FROM {_FORWARD}""",
        "sparse",
    ),
)
def back_fill(spark, sf_dir):
    rows = clean.fill_voltage(tables.sparse(spark, sf_dir))
    return rows.select("mote_id", "timestamp", "voltage")


@query(
    "w2_back_fill_per_mote",
    sql(
        f"""SELECT mote_id, "timestamp", coalesce(forward, first_value(forward IGNORE NULLS) OVER
            (PARTITION BY mote_id ORDER BY "timestamp", epoch ROWS BETWEEN CURRENT ROW
             AND UNBOUNDED FOLLOWING)) AS voltage FROM {_FORWARD}""",
        "sparse",
    ),
)
def back_fill_per_mote(spark, sf_dir):
    rows = clean.fill_voltage(tables.sparse(spark, sf_dir), cross_mote_backfill=False)
    return rows.select("mote_id", "timestamp", "voltage")


_SCHEDULE = """SELECT mote_id, "timestamp", coalesce(gap, 0) / CAST(1000000 AS DOUBLE)
      AS gap_seconds, CAST(sum(greatest(coalesce(gap, 0), 0)) OVER (PARTITION BY mote_id
        ORDER BY "timestamp", epoch ROWS UNBOUNDED PRECEDING) AS BIGINT)
        / CAST(1000000 AS DOUBLE) / 100 AS replay_seconds
    FROM (SELECT mote_id, "timestamp", epoch, epoch_us("timestamp") - lag(epoch_us("timestamp"))
      OVER (PARTITION BY mote_id ORDER BY "timestamp", epoch) AS gap FROM sparse)"""


@query("w3_replay_schedule", sql(_SCHEDULE, "sparse"))
def replay_schedule(spark, sf_dir):
    rows = remap.replay_schedule(tables.sparse(spark, sf_dir))
    return rows.select("mote_id", "timestamp", "gap_seconds", "replay_seconds")


@query(
    "w5_first_per_key",
    sql(
        """SELECT mote_id, h, event_id FROM (SELECT mote_id, event_id, date_trunc('hour', _time) AS h
             FROM points) QUALIFY row_number() OVER (PARTITION BY mote_id, h ORDER BY event_id) = 1""",
        "points",
    ),
)
def first_per_key(spark, sf_dir):
    hour = F.date_trunc("hour", "_time").cast("timestamp_ntz")
    rows = tables.points(spark, sf_dir).select("mote_id", "event_id", hour.alias("h"))
    return dedup.first_per_key(rows, ["mote_id", "h"], ["event_id"])


@query(
    "w6_last_per_point",
    sql(
        """SELECT mote_id, _field, date_trunc('hour', _time) AS _time, arg_max(_value, event_id) AS _value
           FROM points GROUP BY 1, 2, 3""",
        "points",
    ),
)
def last_per_point(spark, sf_dir):
    hour = F.date_trunc("hour", "_time").cast("timestamp_ntz")
    rows = tables.points(spark, sf_dir).withColumn("_time", hour)
    return dedup.last_per_point(rows, "event_id").drop("measurement")


@query(
    "w7_position_split",
    """SELECT event_id, i < floor(n * CAST(0.8 AS DOUBLE)) AS historical FROM (SELECT event_id,
         row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)""",
)
def position_split(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select(
        "event_id", "ts", times.micros(F.col("ts")).alias("at")
    )
    historical, incremental = remap.position_split(
        events, "at", ["ts", "event_id"], ties=["event_id"]
    )
    return (
        historical.withColumn("historical", F.lit(True))
        .unionByName(incremental.withColumn("historical", F.lit(False)))
        .select("event_id", "historical")
    )


@query(
    "r8_line_split",
    sql(
        """SELECT line, event_id AS position, event_id <
             floor((SELECT count(*) FROM events) * CAST(0.8 AS DOUBLE)) AS historical FROM lines""",
        "lines",
    ),
)
def line_split(spark, sf_dir):
    path = scratch_path(spark, "lines")
    tables.lines(spark, sf_dir).orderBy("event_id").select("line").write.text(path)
    historical, incremental = remap.split_lines(spark, path)
    return historical.withColumn("historical", F.lit(True)).unionByName(
        incremental.withColumn("historical", F.lit(False))
    )


_CUT = """(SELECT make_timestamp(epoch_us(min(ts)) + CAST(floor((epoch_us(max(ts))
    - epoch_us(min(ts))) * CAST(0.8 AS DOUBLE)) AS BIGINT)) FROM events)"""


@query(
    "r1_range_split",
    f"SELECT event_id, ts <= {_CUT} AS historical FROM events",
)
def range_split(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "ts")
    parts = remap.range_split(events, "ts")
    named = [p.select("event_id", F.lit(h).alias("historical")) for p, h in zip(parts, (True, False))]
    return named[0].unionByName(named[1])


_HIST = f"(SELECT * FROM events WHERE ts <= {_CUT})"
_INCR = f"(SELECT * FROM events WHERE ts > {_CUT})"
_MOVED_HIST = f"""SELECT event_id, ts, ts + to_microseconds(epoch_us({_SQL_AS_OF})
    - (SELECT max(epoch_us(ts)) FROM {_HIST})) AS updated_timestamp FROM {_HIST}"""
_MOVED_INCR = f"""SELECT event_id, ts, ts + to_microseconds(epoch_us({_SQL_AS_OF}) + 60000000
    - (SELECT min(epoch_us(ts)) FROM {_INCR})) AS updated_timestamp FROM {_INCR}"""


def _present(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "ts")
    return remap.to_present(events, "ts", _AS_OF)


@query("r2_shift_historical", _MOVED_HIST)
def shift_historical(spark, sf_dir):
    return _present(spark, sf_dir)[0]


@query("r3_shift_incremental", _MOVED_INCR)
def shift_incremental(spark, sf_dir):
    return _present(spark, sf_dir)[1]


@query("u2_full_timeline", f"{_MOVED_HIST} UNION ALL {_MOVED_INCR}")
def full_timeline(spark, sf_dir):
    return remap.full_timeline(*_present(spark, sf_dir))


@query(
    "r9_fallback_time",
    sql(
        """SELECT mote_id, "timestamp", CASE WHEN epoch % 3 = 0 THEN "timestamp" + INTERVAL 2 YEAR
           ELSE updated_timestamp END AS updated_timestamp FROM sparse""",
        "sparse",
    ),
)
def fallback_time(spark, sf_dir):
    missing = F.when(F.col("epoch") % 3 != 0, F.col("updated_timestamp"))
    rows = tables.sparse(spark, sf_dir).withColumn("updated_timestamp", missing)
    return remap.with_fallback_time(rows, 2).select("mote_id", "timestamp", "updated_timestamp")


@query(
    "f7_time_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, dayname(ts) AS day_name,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
       FROM events""",
)
def time_parts(spark, sf_dir):
    ts = F.col("ts")
    return tables.table(spark, sf_dir, "events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        times.day_of_week(ts).alias("day_of_week"),
        times.day_name(ts).alias("day_name"),
        *[c.alias(n) for n, c in times.partition_values(ts).items()],
    )


@query(
    "f8_shifted_days",
    """SELECT event_id, ts + to_days(CAST(event_id % 40 AS INTEGER)) AS shifted,
       date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days FROM events""",
)
def shifted_days(spark, sf_dir):
    ts = F.col("ts")
    return tables.table(spark, sf_dir, "events").select(
        "event_id",
        times.shift_days(ts, (F.col("event_id") % 40).cast("int")).alias("shifted"),
        F.date_diff(ts.cast("date"), F.lit("2024-01-01").cast("date"))
        .cast("bigint")
        .alias("days"),
    )


@query(
    "f9_replaced_date",
    """SELECT event_id, DATE '2026-02-10' + CAST(event_id % 5 AS INTEGER)
       + (ts - date_trunc('day', ts)) AS moved FROM events""",
)
def replaced_date(spark, sf_dir):
    new = F.date_add(times.day(_AS_OF.date()), (F.col("event_id") % 5).cast("int"))
    return tables.table(spark, sf_dir, "events").select(
        "event_id", times.with_date(F.col("ts"), new).alias("moved")
    )


@query(
    "f10_shifted_years",
    sql(
        """SELECT mote_id, "timestamp", "timestamp" + to_years(21 + mote_id % 3) AS moved,
           "timestamp" + to_days(59) - INTERVAL 4 YEAR AS near_leap_day FROM sparse""",
        "sparse",
    ),
)
def shifted_years(spark, sf_dir):
    ts = F.col("timestamp")
    return tables.sparse(spark, sf_dir).select(
        "mote_id",
        "timestamp",
        times.shift_years(ts, 21 + F.col("mote_id") % 3).alias("moved"),
        times.shift_years(times.shift_days(ts, 59), -4).alias("near_leap_day"),
    )


@query(
    "f11_event_time",
    sql(
        """SELECT epoch, CASE WHEN epoch % 4 = 0 THEN strftime("timestamp", '%Y-%m-%d')
             WHEN epoch % 4 = 1 THEN strftime("timestamp", '%Y-%m-%d')
             ELSE strftime(updated_timestamp, '%Y-%m-%d') END AS event_time FROM sparse""",
        "sparse",
    ),
)
def event_time(spark, sf_dir):
    as_text = "yyyy-MM-dd"
    updated = F.date_format("updated_timestamp", as_text)
    remainder = F.col("epoch") % 4
    rows = tables.sparse(spark, sf_dir).select(
        "epoch",
        F.when(remainder == 0, "").when(remainder > 1, updated).alias("updated_timestamp"),
        F.date_format("timestamp", as_text).alias("timestamp"),
    )
    return rows.select("epoch", times.event_time().alias("event_time"))


@query(
    "f12_dark_when_missing",
    sql("""SELECT epoch, coalesce(light, 0) AS light FROM sparse""", "sparse"),
)
def dark_when_missing(spark, sf_dir):
    return clean.dark_when_missing(tables.sparse(spark, sf_dir)).select("epoch", "light")


_STAMP = "%Y-%m-%dT%H:%M:%S.%f"


@query(
    "p17_message_envelope",
    sql(
        f"""SELECT mote_id, epoch, temperature, humidity, light, voltage,
            regexp_replace(strftime("timestamp", '{_STAMP}'), '\\.000000$', '') AS "timestamp",
            regexp_replace(strftime(updated_timestamp, '{_STAMP}'), '\\.000000$', '')
              AS updated_timestamp,
            strftime("timestamp", '{_STAMP}') AS original_timestamp,
            CAST(mote_id AS VARCHAR) AS key FROM sparse""",
        "sparse",
    ),
)
def message_envelope(spark, sf_dir):
    sent = messages.to_messages(tables.sparse(spark, sf_dir))
    body = F.from_json("value", messages.MESSAGE).alias("m")
    return sent.select("key", body).select("key", "m.*")


@query(
    "d8_per_mote_order",
    sql("""SELECT mote_id, "timestamp", epoch FROM sparse""", "sparse"),
)
def per_mote_order(spark, sf_dir):
    return clean.per_mote_order(tables.sparse(spark, sf_dir)).select(
        "mote_id", "timestamp", "epoch"
    )
