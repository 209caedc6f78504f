"""Queries of the hot store: ranges, summaries, latest values, top motes."""

from functools import reduce

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators import profile, rollups, timeseries
from sensorlake.operators.distinct import DistinctMotes
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import sql
from sensorlake.schemas import METRICS
from sensorlake.session import scratch_path
from sensorlake.streaming.latest import LatestTable

_VALID = ", ".join(f"'{m}'" for m in METRICS)
_WIDE = ", ".join(f"max(CASE WHEN _field = '{m}' THEN _value END) AS {m}" for m in METRICS)


def _range(interval):
    return f"_time >= as_of - INTERVAL {interval} AND _time < as_of"


def _args(spark, sf_dir):
    return tables.points(spark, sf_dir), tables.event_clock(spark, sf_dir)


@query(
    "s16_bucket_scan",
    sql("SELECT measurement, _field, count(*) AS n FROM points GROUP BY ALL", "points"),
)
def bucket_scan(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    return points.groupBy("measurement", "_field").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s17_peek",
    sql(
        "SELECT mote_id, _field, _value, _time FROM points ORDER BY event_id LIMIT 5",
        "points",
    ),
)
def peek(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    return points.orderBy("event_id").select("mote_id", "_field", "_value", "_time").limit(5)


@query(
    "p1_time_range",
    sql(
        """SELECT 'relative' AS kind, count(*) AS n FROM points, clock
           WHERE _time >= as_of - INTERVAL 36 HOUR AND _time < as_of - INTERVAL 90 MINUTE
           UNION ALL SELECT 'iso', count(*) FROM points
           WHERE _time >= TIMESTAMP '2024-01-05 00:00:00' AND _time < TIMESTAMP '2024-01-09 12:00:00'
           UNION ALL SELECT 'all', count(*) FROM points""",
        "points",
        "clock",
    ),
)
def time_range(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    ranges = {
        "relative": ("-36h", "-1h30m"),
        "iso": ("2024-01-05T00:00:00Z", "2024-01-09T12:00:00"),
        "all": (0, "now()"),
    }
    counts = points.agg(
        *[
            F.count_if(times.in_range("_time", start, as_of, stop)).alias(kind)
            for kind, (start, stop) in ranges.items()
        ]
    )
    return counts.unpivot([], list(ranges), "kind", "n")


@query(
    "p2_field_filter",
    sql(
        f"""SELECT mote_id, _value, _time FROM points, clock WHERE {_range('7 DAY')}
            AND measurement = 'sensor_reading' AND _field = 'humidity'""",
        "points",
        "clock",
    ),
)
def field_filter(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    found = timeseries.select_points(points, as_of, "-7d", metric="humidity")
    return found.select("mote_id", "_value", "_time")


@query(
    "p3_mote_filter",
    sql(
        f"""SELECT _field, _value, _time FROM points, clock
            WHERE {_range('30 DAY')} AND mote_id = '7'""",
        "points",
        "clock",
    ),
)
def mote_filter(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    found = timeseries.select_points(points, as_of, "-30d", mote_id=7)
    return found.select("_field", "_value", "_time")


@query(
    "p4_keep_columns",
    sql(
        f"""SELECT mote_id, _time AS "timestamp", _field, _value FROM points, clock
            WHERE {_range('24 HOUR')}""",
        "points",
        "clock",
    ),
)
def keep_columns(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    found = timeseries.select_points(points, as_of, "-24h").drop("measurement", "event_id")
    return found.withColumnRenamed("_time", "timestamp")


@query(
    "p5_metric_whitelist",
    sql(
        f"""SELECT _field AS metric, count(*) AS n FROM points
            WHERE _field IN ({_VALID}) GROUP BY 1""",
        "points",
    ),
)
def metric_whitelist(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    fields = [timeseries.check_metric(m) for m in METRICS]
    found = timeseries.select_points(points, as_of, 0).filter(F.col("_field").isin(fields))
    return found.groupBy(F.col("_field").alias("metric")).agg(F.count(F.lit(1)).alias("n"))


def _summary_sql(metric, where):
    return f"""SELECT '{metric}' AS metric, round(avg(_value), 4) AS mean,
        round(min(_value), 4) AS min, round(max(_value), 4) AS max, count(_value) AS count
        FROM points, clock WHERE _field = '{metric}' AND {where}"""


@query(
    "a1_metric_summary",
    sql(
        " UNION ALL ".join(_summary_sql(m, _range("24 HOUR")) for m in METRICS),
        "points",
        "clock",
    ),
)
def metric_summary(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    each = [timeseries.metric_summary(points, m, as_of, "-24h") for m in METRICS]
    return reduce(lambda a, b: a.unionByName(b), each)


@query(
    "a1_metric_summary_of_mote",
    sql(_summary_sql("temperature", _range("30 DAY") + " AND mote_id = '12'"), "points", "clock"),
)
def metric_summary_of_mote(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.metric_summary(points, "temperature", as_of, "-30d", mote_id=12)


@query(
    "a1_metric_summary_empty",
    sql(
        _summary_sql("light", _range("30 DAY") + " AND mote_id = 'no such mote'"),
        "points",
        "clock",
    ),
)
def metric_summary_empty(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.metric_summary(points, "light", as_of, "-30d", mote_id="no such mote")


@query(
    "a2_active_motes",
    sql(
        f"SELECT count(DISTINCT mote_id) AS active_motes FROM points, clock WHERE {_range('15 MINUTE')}",
        "points",
        "clock",
    ),
)
def active_motes(spark, sf_dir):
    return timeseries.active_motes(*_args(spark, sf_dir))


@query(
    "a3_mote_list",
    sql(
        f"SELECT DISTINCT mote_id FROM points, clock WHERE {_range('24 HOUR')} ORDER BY mote_id",
        "points",
        "clock",
    ),
)
def mote_list(spark, sf_dir):
    return timeseries.mote_list(*_args(spark, sf_dir))


@query(
    "a4_ingestion_rate",
    sql(
        f"""SELECT round(count(_value) / CAST(5 AS DOUBLE), 2) AS records_per_minute,
            count(_value) AS total FROM points, clock
            WHERE _field = 'temperature' AND {_range('5 MINUTE')}""",
        "points",
        "clock",
    ),
)
def ingestion_rate(spark, sf_dir):
    return timeseries.ingestion_rate(*_args(spark, sf_dir))


@query(
    "a5_mean_of_means",
    sql(
        f"""SELECT round(avg(m), 2) AS mean, count(m) AS n_motes FROM (
            SELECT mote_id, avg(_value) AS m FROM points, clock
            WHERE _field = 'temperature' AND {_range('6 HOUR')} GROUP BY 1)""",
        "points",
        "clock",
    ),
)
def mean_of_means(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.mean_of_means(points, "temperature", as_of, "-6h")


@query(
    "a6_record_count",
    sql(
        f"""SELECT count(_value) AS n_records FROM points, clock
            WHERE _field = 'temperature' AND {_range('24 HOUR')}""",
        "points",
        "clock",
    ),
)
def record_count(spark, sf_dir):
    return timeseries.record_count(*_args(spark, sf_dir))


@query(
    "a7_minute_mean",
    sql(
        """SELECT mote_id, time_bucket(INTERVAL 1 MINUTE, _time) + INTERVAL 1 MINUTE AS _time,
           round(avg(_value), 6) AS _value FROM points, clock
           WHERE _field = 'temperature' AND _time >= TIMESTAMP '1970-01-01' AND _time < as_of
           GROUP BY 1, 2""",
        "points",
        "clock",
    ),
)
def minute_mean(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    means = timeseries.minute_mean(points, "temperature", as_of, 0)
    return means.withColumn("_value", F.round("_value", 6))


@query(
    "a25_latest_points",
    sql(
        f"""SELECT _time, mote_id, {_WIDE} FROM (
            SELECT mote_id, _field, arg_max(_value, _time) AS _value, max(_time) AS _time
            FROM points, clock WHERE {_range('24 HOUR')} GROUP BY 1, 2)
            GROUP BY _time, mote_id""",
        "points",
        "clock",
    ),
)
def latest_points(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.latest_points(points, as_of, "-24h")


@query(
    "a25_latest_reading",
    sql(
        f"""SELECT mote_id, {_WIDE}, max(_time) AS last_seen FROM (
            SELECT mote_id, _field, arg_max(_value, _time) AS _value, max(_time) AS _time
            FROM points, clock WHERE {_range('30 DAY')} GROUP BY 1, 2)
            GROUP BY mote_id""",
        "points",
        "clock",
    ),
)
def latest_reading(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.latest_reading(points, as_of, "-30d")


_ROUNDED = ", ".join(f"round({m}, 2) AS {m}" for m in METRICS)


@query(
    "p18_latest_grid",
    sql(
        f"""SELECT mote_id, {_ROUNDED}, _time AS last_seen FROM (
            SELECT _time, mote_id, {_WIDE} FROM (
              SELECT mote_id, _field, arg_max(_value, _time) / 3 AS _value, max(_time) AS _time
              FROM points, clock WHERE {_range('24 HOUR')} GROUP BY 1, 2)
            GROUP BY _time, mote_id)""",
        "points",
        "clock",
    ),
)
def latest_grid(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.latest_grid(points.withColumn("_value", F.col("_value") / 3), as_of, "-24h")


@query(
    "a26_freshness",
    sql(
        """SELECT max(_time) AS newest, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00')
             - epoch_us(max(_time))) / CAST(60000000 AS DOUBLE), 4) AS age_minutes,
           (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(_time)))
             / CAST(60000000 AS DOUBLE) < 60 AS fresh FROM points""",
        "points",
    ),
)
def freshness(spark, sf_dir):
    return timeseries.freshness(
        tables.points(spark, sf_dir), times.bound("2024-02-01T00:00:00", None)
    )


@query(
    "a27_time_span",
    sql(
        """SELECT min(_time) AS earliest, max(_time) AS latest,
           (epoch_us(max(_time)) - epoch_us(min(_time))) / CAST(1000000 AS DOUBLE) AS span_seconds
           FROM points""",
        "points",
    ),
)
def time_span(spark, sf_dir):
    return timeseries.time_span(tables.points(spark, sf_dir))


@query("a29_point_count", sql("SELECT count(*) AS n_points FROM points", "points"))
def point_count(spark, sf_dir):
    return timeseries.point_count(tables.points(spark, sf_dir))


@query(
    "a30_series_overview",
    sql(
        """SELECT DISTINCT 'measurement' AS kind, measurement AS name FROM points
           UNION ALL SELECT DISTINCT 'field', _field FROM points
           UNION ALL SELECT DISTINCT 'mote', mote_id FROM points""",
        "points",
    ),
)
def series_overview(spark, sf_dir):
    return timeseries.series_overview(tables.points(spark, sf_dir))


@query(
    "a32_mote_count_check",
    sql(
        f"""SELECT count(DISTINCT mote_id) AS n_motes,
            count(DISTINCT mote_id) BETWEEN 42 AND 44 AS expected
            FROM points, clock WHERE {_range('24 HOUR')}""",
        "points",
        "clock",
    ),
)
def mote_count_check(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.mote_count_check(timeseries.select_points(points, as_of, "-24h"))


@query(
    "l1_history",
    sql(
        f"""SELECT mote_id, _time, {_WIDE} FROM points, clock
            WHERE mote_id = '3' AND {_range('30 DAY')} GROUP BY 1, 2 ORDER BY _time LIMIT 20""",
        "points",
        "clock",
    ),
)
def history(spark, sf_dir):
    points, as_of = _args(spark, sf_dir)
    return timeseries.history(points, 3, as_of, "-30d", limit=20)


@query(
    "l2_per_series_limit",
    sql(
        """SELECT mote_id, _field, _time, _value FROM points
           QUALIFY row_number() OVER (PARTITION BY mote_id, _field ORDER BY _time, event_id) <= 3""",
        "points",
    ),
)
def per_series_limit(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    first = timeseries.first_per_series(points, 3, ("mote_id", "_field"), ("_time", "event_id"))
    return first.select("mote_id", "_field", "_time", "_value")


@query(
    "l3_newest_readings",
    sql(
        """SELECT mote_id, _field, _time, _value FROM points
           ORDER BY _time DESC, mote_id, _field LIMIT 20""",
        "points",
    ),
)
def newest_readings(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    rows = timeseries.newest(points, 20, ties=("mote_id", "_field"))
    return rows.select("mote_id", "_field", "_time", "_value")


@query(
    "l4_top_motes",
    sql(
        "SELECT mote_id, count(*) AS n FROM points GROUP BY 1 ORDER BY n DESC, mote_id LIMIT 5",
        "points",
    ),
)
def top_motes(spark, sf_dir):
    return timeseries.top_motes(tables.points(spark, sf_dir), 5)


@query(
    "l8_newest_record",
    sql(
        """SELECT mote_id, _field, _value, _time FROM points
           ORDER BY _time DESC, event_id DESC LIMIT 1""",
        "points",
    ),
)
def newest_record(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    row = timeseries.newest_record(points, ties=("event_id",))
    return row.select("mote_id", "_field", "_value", "_time")


@query(
    "j2_top_mote_series",
    sql(
        """SELECT mote_id, _time, _value FROM points WHERE _field = 'temperature' AND mote_id IN (
             SELECT mote_id FROM points WHERE _field = 'temperature'
             GROUP BY 1 ORDER BY count(*) DESC, mote_id LIMIT 5)""",
        "points",
    ),
)
def top_mote_series(spark, sf_dir):
    points = tables.points(spark, sf_dir).filter("_field = 'temperature'")
    return timeseries.of_top_motes(points, 5).select("mote_id", "_time", "_value")


@query(
    "u5_distinct_values",
    sql("SELECT DISTINCT mote_id, _field FROM points", "points"),
)
def distinct_values(spark, sf_dir):
    return tables.points(spark, sf_dir).select("mote_id", "_field").distinct()


@query(
    "d2_points_from_readings",
    sql(
        " UNION ALL ".join(
            f"SELECT '{m}' AS _field, count({m}) AS n, round(sum({m}) / 7, 4) AS total FROM dense"
            for m in METRICS
        ),
        "dense",
    ),
)
def points_from_readings(spark, sf_dir):
    points = timeseries.to_points(tables.dense(spark, sf_dir), "timestamp")
    return points.groupBy("_field").agg(
        F.count("_value").alias("n"), F.round(F.sum("_value") / 7, 4).alias("total")
    )


@query(
    "d2_readings_from_points",
    sql(f"SELECT mote_id, _time, {_WIDE} FROM points GROUP BY 1, 2", "points"),
)
def readings_from_points(spark, sf_dir):
    return timeseries.to_readings(tables.points(spark, sf_dir))


@query(
    "f17_field_share",
    sql(
        """SELECT _field, count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM points) AS percent
           FROM points GROUP BY 1""",
        "points",
    ),
)
def field_share(spark, sf_dir):
    points = tables.points(spark, sf_dir)
    total = points.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = points.groupBy("_field").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("_field", profile.share(F.col("n"), total).alias("percent"))


def _rolled(spark, sf_dir):
    """Rollups of the whole table, the points of the edges, and the clock."""
    points, as_of = _args(spark, sf_dir)
    path = scratch_path(spark, "rollups")
    rollups.write(points, path)
    return rollups.read(spark, path), points, as_of


@query(
    "a1_from_rollups",
    sql(" UNION ALL ".join(_summary_sql(m, _range("30 DAY")) for m in METRICS), "points", "clock"),
)
def summary_from_rollups(spark, sf_dir):
    parts, points, as_of = _rolled(spark, sf_dir)
    each = [rollups.metric_summary(parts, points, m, as_of, "-30d") for m in METRICS]
    return reduce(lambda a, b: a.unionByName(b), each)


@query(
    "a7_from_rollups",
    sql(
        """SELECT mote_id, time_bucket(INTERVAL 1 MINUTE, _time) + INTERVAL 1 MINUTE AS _time,
           round(avg(_value), 6) AS _value FROM points, clock
           WHERE _field = 'temperature' AND _time >= as_of - INTERVAL 30 DAY AND _time < as_of
           GROUP BY 1, 2""",
        "points",
        "clock",
    ),
)
def minutes_from_rollups(spark, sf_dir):
    parts, points, as_of = _rolled(spark, sf_dir)
    means = rollups.minute_mean(parts, points, "temperature", as_of, "-30d")
    return means.withColumn("_value", F.round("_value", 6))


def _latest_table(spark, sf_dir):
    """The newest values after batches that come out of order, one of them twice."""
    points, as_of = _args(spark, sf_dir)
    latest = LatestTable(spark, scratch_path(spark, "latest"))
    for batch, part in enumerate((2, 0, 1)):
        some = points.filter(F.col("event_id") % 3 == part)
        for _ in range(1 + batch % 2):
            latest.upsert(some, "load", batch)
    latest.fold()
    return latest, as_of


@query(
    "a25_from_latest_table",
    sql(
        f"""SELECT mote_id, {_WIDE}, max(_time) AS last_seen FROM (
            SELECT mote_id, _field, arg_max(_value, _time) AS _value, max(_time) AS _time
            FROM points, clock WHERE {_range('30 DAY')} GROUP BY 1, 2)
            GROUP BY mote_id""",
        "points",
        "clock",
    ),
)
def reading_from_latest_table(spark, sf_dir):
    latest, as_of = _latest_table(spark, sf_dir)
    return latest.reading(as_of, "-30d")


@query(
    "l8_from_latest_table",
    sql(
        """SELECT mote_id, _field, _value, _time FROM points
           ORDER BY _time DESC, mote_id DESC, _field DESC LIMIT 1""",
        "points",
    ),
)
def newest_from_latest_table(spark, sf_dir):
    latest, _ = _latest_table(spark, sf_dir)
    return latest.newest_record().drop("measurement")


def _seen_motes(spark, sf_dir):
    """Bitmaps of the motes in two loads; every third mote has a name for an id."""
    points, as_of = _args(spark, sf_dir)
    third = F.col("mote_id").cast("long") % 3 == 0
    named = F.when(third, F.concat(F.lit("mote-"), "mote_id")).otherwise(F.col("mote_id"))
    points = points.withColumn("mote_id", named)
    motes = DistinctMotes(spark, scratch_path(spark, "motes"))
    for load in range(2):
        motes.add(points.filter(F.col("event_id") % 2 == load))
    return motes, points, as_of


_SPANS = {"15m": "15 MINUTE", "24h": "24 HOUR", "9d": "9 DAY", "30d": "30 DAY"}


@query(
    "a2_from_bitmaps",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{k}' AS span, count(DISTINCT mote_id) AS n_motes FROM points, clock
                WHERE {_range(v)}""" for k, v in _SPANS.items()
        ),
        "points",
        "clock",
    ),
)
def motes_from_bitmaps(spark, sf_dir):
    motes, points, as_of = _seen_motes(spark, sf_dir)
    each = [
        motes.count(points, as_of, f"-{k}").select(F.lit(k).alias("span"), "n_motes")
        for k in _SPANS
    ]
    return reduce(lambda a, b: a.unionByName(b), each)


@query(
    "a12_motes_per_day",
    sql(
        """SELECT CAST(_time AS DATE) AS date, count(DISTINCT mote_id) AS n_motes
           FROM points GROUP BY 1""",
        "points",
    ),
)
def motes_per_day(spark, sf_dir):
    return _seen_motes(spark, sf_dir)[0].per_day()
