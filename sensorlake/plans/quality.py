"""Queries of the historical pages and data-quality reports."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from sensorlake.operators import (
    clean, features, joins, profile, remap, samples, sketches, timeseries
)
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import sql
from sensorlake.schemas import METRICS, PHYSICS_BOUNDS, VALID_RANGES
from sensorlake.session import scratch_path


def _double(value):
    return f"CAST({value} AS DOUBLE)"


def _each(template):
    return " UNION ALL ".join(template.format(m=m) for m in METRICS)


@query(
    "p13_physics_bounds",
    sql(
        """SELECT mote_id, "timestamp", temperature, humidity, light, voltage FROM dense WHERE """
        + " AND ".join(
            f"({m} IS NULL OR {m} BETWEEN {_double(lo)} AND {_double(hi)})"
            for m, (lo, hi) in PHYSICS_BOUNDS.items()
        ),
        "dense",
    ),
)
def physics_bounds(spark, sf_dir):
    return clean.within_physics(tables.dense(spark, sf_dir))


@query(
    "p13_physics_bounds_sparse",
    sql(
        """SELECT mote_id, "timestamp" FROM sparse WHERE """
        + " AND ".join(
            f"({m} IS NULL OR {m} BETWEEN {_double(lo)} AND {_double(hi)})"
            for m, (lo, hi) in PHYSICS_BOUNDS.items()
        ),
        "sparse",
    ),
)
def physics_bounds_sparse(spark, sf_dir):
    rows = clean.within_physics(tables.sparse(spark, sf_dir))
    return rows.select("mote_id", "timestamp")


_OUTSIDE = " OR ".join(
    f"NOT {m} BETWEEN {_double(lo)} AND {_double(hi)}" for m, (lo, hi) in VALID_RANGES.items()
)


@query(
    "p14_valid_ranges",
    sql(f"SELECT count(*) AS n_rows, count(*) FILTER ({_OUTSIDE}) AS n_outside FROM dense", "dense"),
)
def valid_ranges(spark, sf_dir):
    return tables.dense(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(clean.out_of_valid_range()).alias("n_outside"),
    )


@query(
    "p15_date_range",
    sql(
        """SELECT mote_id, "timestamp" FROM dense
           WHERE CAST("timestamp" AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-06-30'""",
        "dense",
    ),
)
def date_range(spark, sf_dir):
    rows = profile.between_dates(
        tables.dense(spark, sf_dir), date(1997, 3, 1), date(1997, 6, 30)
    )
    return rows.select("mote_id", "timestamp")


_ALL = 'mote_id, "timestamp", temperature, humidity, light, voltage'


@query(
    "p19_display_rows",
    sql(
        f"""SELECT {_ALL} FROM dense
            ORDER BY "timestamp", mote_id, temperature, humidity, voltage LIMIT 200""",
        "dense",
    ),
)
def display_rows(spark, sf_dir):
    order = ("timestamp", "mote_id", "temperature", "humidity", "voltage")
    return profile.display_rows(tables.dense(spark, sf_dir), 200, order)


@query(
    "l6_earliest_rows",
    sql(
        f"""SELECT {_ALL} FROM dense
            ORDER BY "timestamp", mote_id, temperature, humidity, voltage LIMIT 12000""",
        "dense",
    ),
)
def earliest_rows(spark, sf_dir):
    ties = ("mote_id", "temperature", "humidity", "voltage")
    return profile.earliest_rows(tables.dense(spark, sf_dir), 12_000, "timestamp", ties)


@query(
    "a8_daily_average",
    sql(
        """SELECT CAST("timestamp" AS DATE) AS date, round(avg(temperature), 6) AS avg_value
           FROM sparse GROUP BY 1 HAVING avg(temperature) IS NOT NULL""",
        "sparse",
    ),
)
def daily_average(spark, sf_dir):
    days = profile.daily_average(tables.sparse(spark, sf_dir), "temperature")
    return days.withColumn("avg_value", F.round("avg_value", 6))


_HOURS = ", ".join(
    f"""round(avg(CASE WHEN hour("timestamp") = {h} THEN temperature END), 6) AS h{h:02d}"""
    for h in range(24)
)


@query(
    "a9_weekday_hour",
    sql(
        f"""SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
            dayname("timestamp") AS day_name, {_HOURS} FROM sparse GROUP BY 1, 2""",
        "sparse",
    ),
)
def weekday_hour(spark, sf_dir):
    grid = profile.weekday_hour(tables.sparse(spark, sf_dir), "temperature")
    return grid.withColumns({f"h{h:02d}": F.round(f"h{h:02d}", 6) for h in range(24)})


def _histogram_sql(metric, view):
    width = f"((SELECT max({metric}) FROM {view}) - (SELECT min({metric}) FROM {view})) / 50"
    return f"""SELECT bin, round(lo + (bin - 1) * {width}, 6) AS lower, n FROM (
        SELECT CAST(least(floor(({metric} - lo) * 50 / (hi - lo)) + 1, 50) AS INTEGER) AS bin,
          any_value(lo) AS lo, count(*) AS n
        FROM {view}, (SELECT min({metric}) AS lo, max({metric}) AS hi FROM {view})
        WHERE {metric} IS NOT NULL GROUP BY 1)"""


@query("a10_histogram", sql(_histogram_sql("temperature", "sparse"), "sparse"))
def histogram(spark, sf_dir):
    bins = profile.histogram(tables.sparse(spark, sf_dir), "temperature")
    return bins.withColumn("lower", F.round("lower", 6))


_BOX = ", ".join(
    f"round(quantile_cont(temperature, {_double(p)}), 6) AS {n}"
    for n, p in (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1))
)


@query(
    "a11_box_top8",
    sql(
        f"""SELECT mote_id, {_BOX} FROM dense WHERE mote_id IN (SELECT mote_id FROM dense
            GROUP BY 1 ORDER BY count(*) DESC, mote_id LIMIT 8) GROUP BY 1""",
        "dense",
    ),
)
def box_top8(spark, sf_dir):
    box = profile.box_summary(tables.dense(spark, sf_dir), "temperature")
    return box.select(
        "mote_id", *[F.round(c, 6).alias(c) for c in ("min", "q1", "median", "q3", "max")]
    )


@query(
    "a12_kpis",
    sql(
        """SELECT count(*) AS n_rows, count(DISTINCT mote_id) AS n_motes,
           CAST(min("timestamp") AS DATE) AS first_date, CAST(max("timestamp") AS DATE) AS last_date
           FROM dense""",
        "dense",
    ),
)
def kpis(spark, sf_dir):
    return profile.kpis(tables.dense(spark, sf_dir))


@query(
    "a13_null_rates",
    sql(
        _each(
            """SELECT '{m}' AS metric, round(avg(CASE WHEN {m} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)
               AS null_percent, avg(CASE WHEN {m} IS NULL THEN 1.0 ELSE 0.0 END) * 100 < 20 AS ok,
               count(DISTINCT mote_id) AS n_motes FROM sparse"""
        ),
        "sparse",
    ),
)
def null_rates(spark, sf_dir):
    rates = profile.null_rates(tables.sparse(spark, sf_dir))
    return rates.withColumn("null_percent", F.round("null_percent", 6))


@query(
    "a14_date_distribution",
    sql(
        """SELECT CAST(updated_timestamp AS DATE) AS date, count(*) AS n_rows,
           count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM sparse) AS percent
           FROM sparse GROUP BY 1 ORDER BY n_rows DESC, date LIMIT 10""",
        "sparse",
    ),
)
def date_distribution(spark, sf_dir):
    return profile.date_distribution(tables.sparse(spark, sf_dir))


@query(
    "a15_field_stats",
    sql(
        _each(
            """SELECT '{m}' AS field, count({m}) AS n, min({m}) AS min, max({m}) AS max,
               round(avg({m}), 6) AS mean FROM dense"""
        ),
        "dense",
    ),
)
def field_stats(spark, sf_dir):
    return profile.field_stats(tables.dense(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


_NOW = "(SELECT min(updated_timestamp) + INTERVAL 20 DAY FROM sparse)"


@query(
    "a16_remap_check",
    sql(
        f"""SELECT count(updated_timestamp) AS n_rows, count(*) - count(updated_timestamp) AS n_errors,
            count(*) FILTER (CAST(updated_timestamp AS DATE) = CAST({_NOW} AS DATE)) AS n_today,
            count(*) FILTER (CAST(updated_timestamp AS DATE) <> CAST({_NOW} AS DATE)) AS n_historical,
            count(*) FILTER (updated_timestamp > {_NOW}) AS n_future,
            count(DISTINCT mote_id) FILTER (updated_timestamp IS NOT NULL) AS n_motes,
            count(*) FILTER (updated_timestamp > {_NOW} OR updated_timestamp IS NULL) = 0
              AND count(*) > 0 AS passed
            FROM (SELECT mote_id, CASE WHEN epoch % 7 > 0 THEN updated_timestamp END
              AS updated_timestamp FROM sparse)""",
        "sparse",
    ),
)
def remap_check(spark, sf_dir):
    moved = F.when(F.col("epoch") % 7 > 0, F.col("updated_timestamp"))
    rows = tables.sparse(spark, sf_dir).withColumn("updated_timestamp", moved)
    first = tables.table(spark, sf_dir, "events").agg(F.min("ts")).first()[0]
    return profile.remap_check(rows, first + tables.MOVED + timedelta(days=20))


@query(
    "a17_rows_per_date",
    sql(
        """SELECT CAST("timestamp" AS DATE) AS date, count(*) AS n_rows FROM dense GROUP BY 1""",
        "dense",
    ),
)
def rows_per_date(spark, sf_dir):
    return profile.rows_per_date(tables.dense(spark, sf_dir))


@query(
    "a18_out_of_range",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS field, count({m}) AS n, count(*) FILTER
                (NOT {m} BETWEEN {_double(lo)} AND {_double(hi)}) AS n_outside FROM dense"""
            for m, (lo, hi) in VALID_RANGES.items()
        ),
        "dense",
    ),
)
def out_of_range(spark, sf_dir):
    return profile.out_of_range(tables.dense(spark, sf_dir))


@query(
    "a31_today_overview",
    sql(
        """SELECT count(*) AS n_rows, count(DISTINCT mote_id) AS n_motes,
           min(updated_timestamp) AS first, max(updated_timestamp) AS last FROM sparse
           WHERE CAST(updated_timestamp AS DATE) =
             (SELECT CAST(max(updated_timestamp) AS DATE) FROM sparse)""",
        "sparse",
    ),
)
def today_overview(spark, sf_dir):
    return profile.today_overview(
        tables.sparse(spark, sf_dir), tables.moved_clock(spark, sf_dir)
    )


@query(
    "a31_today_top_motes",
    sql(
        """SELECT mote_id, count(*) AS n FROM sparse WHERE CAST(updated_timestamp AS DATE) =
             (SELECT CAST(max(updated_timestamp) AS DATE) FROM sparse)
           GROUP BY 1 ORDER BY n DESC, mote_id LIMIT 5""",
        "sparse",
    ),
)
def today_top_motes(spark, sf_dir):
    rows = clean.on_day(tables.sparse(spark, sf_dir), tables.moved_clock(spark, sf_dir))
    return timeseries.top_motes(rows, 5)


@query(
    "l9_systematic_sample",
    """SELECT event_id, i AS position FROM
             (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)
           WHERE i < 3 OR i % 2500 = 0 ORDER BY i LIMIT 10""",
)
def systematic_sample(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id")
    return profile.systematic_sample(events, "event_id", ["event_id"], every=2500)


@query(
    "l6_first_rows",
    sql(
        f"""SELECT {_ALL} FROM dense
            ORDER BY "timestamp", mote_id, temperature, humidity, voltage LIMIT 200""",
        "dense",
    ),
)
def first_rows(spark, sf_dir):
    ties = ("mote_id", "temperature", "humidity", "voltage")
    return profile.earliest_rows(tables.dense(spark, sf_dir), 200, "timestamp", ties)


@query(
    "l7_seeded_sample",
    """SELECT event_id, user_id, value FROM events
       ORDER BY substr(md5('42|' || event_id), 1, 13), event_id LIMIT 500""",
)
def seeded_sample(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return features.seeded_sample(events, 500, ["event_id"])


@query(
    "l7_merged_sample",
    """SELECT event_id, user_id, value FROM events
       WHERE ts < (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) FROM events)
       ORDER BY substr(md5('42|' || event_id), 1, 13), event_id LIMIT 500""",
)
def merged_sample(spark, sf_dir):
    """The sample of all days but the last, from what three loads kept of each day."""
    events = tables.table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    path, last = scratch_path(spark, "samples"), tables.event_clock(spark, sf_dir).date()
    for load in range(3):
        samples.write(events.filter(F.col("event_id") % 3 == load), path, 500, ["event_id"], "ts")
    kept = samples.read(spark, path, events.schema)
    days = (date(1970, 1, 1), last - timedelta(days=1))
    return samples.sample(kept, 500, ["event_id"], days).drop("ts")


@query("a11_box_from_sketches")
def box_from_sketches(spark, sf_dir):
    """The box summary from sketches per mote and day: quartiles within the sketches' error."""
    dense, path = tables.dense(spark, sf_dir), scratch_path(spark, "sketches")
    sketches.write(timeseries.to_points(dense, "timestamp"), path)
    return sketches.box_summary(sketches.read(spark, path), "temperature")


@query(
    "a15_extremes_from_sketches",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS field, CAST(count({m}) AS BIGINT) AS n, min({m}) AS min,
                max({m}) AS max FROM dense""" for m in METRICS
        ),
        "dense",
    ),
)
def extremes_from_sketches(spark, sf_dir):
    dense, path = tables.dense(spark, sf_dir), scratch_path(spark, "sketches")
    sketches.write(timeseries.to_points(dense, "timestamp"), path)
    found = sketches.merged(sketches.read(spark, path), "_field")
    return found.select(
        F.col("_field").alias("field"), "n", F.col("least").alias("min"), F.col("most").alias("max")
    )


@query(
    "j1_with_location",
    sql(
        """SELECT mote_id, "timestamp", x, y FROM sparse LEFT JOIN (SELECT
             CAST(s_suppkey AS INTEGER) AS mote_id, CAST(s_nationkey AS DOUBLE) AS x,
             s_acctbal AS y FROM supplier) USING (mote_id)""",
        "sparse",
    ),
)
def with_location(spark, sf_dir):
    rows = joins.with_location(
        tables.sparse(spark, sf_dir).select("mote_id", "timestamp"), tables.locations(spark, sf_dir)
    )
    return rows.select("mote_id", "timestamp", "x", "y")


@query(
    "j1_location_of_mote",
    "SELECT CAST(s_nationkey AS DOUBLE) AS x, s_acctbal AS y FROM supplier WHERE s_suppkey = 5",
)
def location_of_mote(spark, sf_dir):
    return joins.location_of(tables.locations(spark, sf_dir), 5)


@query(
    "a19_load_completeness",
    sql(
        """SELECT e AS expected, s AS stored, s * CAST(100 AS DOUBLE) / e AS percent,
           CASE WHEN s * CAST(100 AS DOUBLE) / e >= 95 THEN 'passed'
                WHEN s * CAST(100 AS DOUBLE) / e >= 80 THEN 'partial' ELSE 'failed' END AS status
           FROM (SELECT
             (SELECT count(*) * 4 FROM dense WHERE "timestamp" <=
               (SELECT make_timestamp(epoch_us(min("timestamp")) + CAST(floor((epoch_us(max("timestamp"))
                - epoch_us(min("timestamp"))) * CAST(0.8 AS DOUBLE)) AS BIGINT)) FROM dense)) AS e,
             (SELECT count(*) * 4 - count(*) FILTER (light > 2300) FROM dense WHERE "timestamp" <=
               (SELECT make_timestamp(epoch_us(min("timestamp")) + CAST(floor((epoch_us(max("timestamp"))
                - epoch_us(min("timestamp"))) * CAST(0.8 AS DOUBLE)) AS BIGINT)) FROM dense)) AS s)""",
        "dense",
    ),
)
def load_completeness(spark, sf_dir):
    expected, _ = remap.range_split(tables.dense(spark, sf_dir), "timestamp")
    stored = timeseries.to_points(
        expected.withColumn("light", F.when(F.col("light") <= 2300, F.col("light"))), "timestamp"
    )
    return joins.load_completeness(expected, stored)
