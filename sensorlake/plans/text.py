"""Queries of the text sources: parsers, guards, reports, line remapping."""

from datetime import datetime

from pyspark.sql import functions as F

from sensorlake.functions import text, times
from sensorlake.operators import clean, remap
from sensorlake.plans import tables
from sensorlake.plans.registry import query
from sensorlake.plans.tables import sql, sql_iso, sql_number, sql_recorded
from sensorlake.schemas import METRICS
from sensorlake.session import scratch_path
from sensorlake.sources import text as sources

_T = r"(SELECT *, regexp_extract_all(line, '\S+') AS t FROM lines)"


def _sql_metrics(nulls):
    return ", ".join(f"{sql_number(f't[{5 + i}]', nulls)} AS {m}" for i, m in enumerate(METRICS))


_PADDED = f"""(SELECT event_id, {sql_number('t[4]', ('?',))} AS mote_id,
    TRY_CAST({sql_number('t[3]', ('?',))} AS BIGINT) AS epoch,
    {sql_recorded('t[1]', 't[2]')} AS "timestamp", {sql_iso('t[9]')} AS updated_timestamp,
    {_sql_metrics(('?',))}, CASE WHEN t[9] <> '?' THEN t[9] END AS updated_text FROM {_T})"""


def _padded(spark, sf_dir):
    return sources.parse_readings(tables.lines(spark, sf_dir), keep=("event_id",))


@query(
    "s1_text_readings",
    sql(
        f"""SELECT event_id, mote_id, epoch, "timestamp", updated_timestamp,
            temperature, humidity, light, voltage FROM {_PADDED}""",
        "lines",
    ),
)
def text_readings(spark, sf_dir):
    return _padded(spark, sf_dir).drop("updated_text")


@query(
    "s2_training_text",
    sql(
        f"""SELECT event_id, TRY_CAST(trunc({sql_number('t[4]')}) AS INTEGER) AS mote_id,
            TRY_CAST({sql_number('t[3]')} AS BIGINT) AS epoch,
            {sql_recorded('t[1]', 't[2]')} AS "timestamp", {sql_iso('t[9]')} AS updated_timestamp,
            {_sql_metrics(())} FROM {_T} WHERE len(t) <= 9""",
        "lines",
    ),
)
def training_text(spark, sf_dir):
    return sources.parse_training(tables.lines(spark, sf_dir), keep=("event_id",))


def _ragged_sql(full):
    def bad(i):
        return (
            f"(t[{i}] <> '?' AND lower(t[{i}]) <> 'nan' AND ({sql_number(f't[{i}]')}) IS NULL)"
        )

    metrics = ", ".join(
        f"CASE WHEN reject IS NULL AND {full} THEN {sql_number(f't[{5 + i}]', ('?',))} END AS {m}"
        for i, m in enumerate(METRICS)
    )
    return f"""SELECT event_id, reject, CASE WHEN reject IS NULL THEN mote END AS mote_id,
        CASE WHEN reject IS NULL THEN t[1] || ' ' || t[2] END AS timestamp_text,
        CASE WHEN reject IS NULL THEN CASE WHEN len(t) = 4 THEN t[4] ELSE t[9] END END
          AS updated_text, {metrics}
        FROM (SELECT *, CASE WHEN NOT (len(t) = 4 OR {full}) THEN len(t) || ' tokens'
              WHEN mote IS NULL THEN 'mote id'
              WHEN {full} AND ({' OR '.join(bad(i) for i in range(5, 9))}) THEN 'metric' END AS reject
          FROM (SELECT *, CASE WHEN len(t) = 4 THEN
                  CASE WHEN regexp_matches(t[3], '^[+-]?\\d+$') THEN TRY_CAST(t[3] AS INTEGER) END
                WHEN {full} THEN TRY_CAST(trunc({sql_number('t[4]')}) AS INTEGER) END AS mote
                FROM {_T}))"""


@query("s3_ragged_lines", sql(_ragged_sql("len(t) = 9"), "lines"))
def ragged_lines(spark, sf_dir):
    return sources.parse_ragged(tables.lines(spark, sf_dir), keep=("event_id",))


@query("s3_ragged_lines_lenient", sql(_ragged_sql("len(t) >= 9"), "lines"))
def ragged_lines_lenient(spark, sf_dir):
    lines = tables.lines(spark, sf_dir)
    return sources.parse_ragged(lines, keep=("event_id",), extra_tokens=True)


_RAW = f"""SELECT event_id, t[1] AS date, t[2] AS time,
    TRY_CAST({sql_number('t[3]')} AS BIGINT) AS epoch, {sql_number('t[4]')} AS moteid,
    {_sql_metrics(('?',))}, {sql_recorded('t[1]', 't[2]')} AS original_ts
    FROM {_T} WHERE len(t) <= 8 AND {sql_recorded('t[1]', 't[2]')} IS NOT NULL"""


@query("s4_raw_columns", sql(_RAW, "lines"))
def raw_columns(spark, sf_dir):
    return sources.parse_raw(tables.lines(spark, sf_dir), keep=("event_id",))


@query(
    "s5_locations",
    """SELECT CAST(s_suppkey AS INTEGER) AS mote_id, CAST(s_nationkey AS DOUBLE) AS x,
       s_acctbal AS y FROM supplier""",
)
def locations(spark, sf_dir):
    path = scratch_path(spark, "locations")
    rows = tables.locations(spark, sf_dir)
    rows.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in rows.columns])).write.text(path)
    return sources.read_locations(spark, path)


@query(
    "s7_csv_columns",
    sql(
        """SELECT CAST(mote_id AS VARCHAR) AS mote_id, CAST("timestamp" AS DATE)::VARCHAR AS date,
           updated_timestamp, temperature, humidity FROM sparse""",
        "sparse",
    ),
)
def csv_columns(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.sparse(spark, sf_dir).select(
        F.col("timestamp").cast("date").alias("date"),
        times.iso_text(F.col("updated_timestamp")).alias("updated_timestamp"),
        "mote_id",
        "temperature",
        "humidity",
    ).write.option("header", True).csv(path)
    return sources.csv_readings(sources.read_csv(spark, path))


@query(
    "s13_text_round_trip",
    sql(
        """SELECT CAST(mote_id AS DOUBLE) AS mote_id, epoch, "timestamp", updated_timestamp,
           temperature, humidity, light, voltage FROM sparse""",
        "sparse",
    ),
)
def text_round_trip(spark, sf_dir):
    path = scratch_path(spark, "text")
    sources.write_readings(tables.sparse(spark, sf_dir), path)
    return sources.read_readings(spark, path).drop("updated_text")


@query(
    "p6_numeric_coercion",
    sql(
        f"""SELECT event_id, {_sql_metrics(())} FROM {_T}""",
        "lines",
    ),
)
def numeric_coercion(spark, sf_dir):
    lines = text.with_tokens(tables.lines(spark, sf_dir), "t")
    raw = lines.select(
        "event_id", *[F.get("t", F.lit(4 + i)).alias(m) for i, m in enumerate(METRICS)]
    )
    return clean.coerce_metrics(raw)


@query(
    "p7_mote_id_guard",
    sql(
        f"""SELECT event_id, CAST(trunc(mote_id) AS INTEGER) AS mote_id FROM {_PADDED}
            WHERE mote_id BETWEEN 1 AND 100""",
        "lines",
    ),
)
def mote_id_guard(spark, sf_dir):
    return clean.valid_mote_ids(_padded(spark, sf_dir)).select("event_id", "mote_id")


_HAS = f"(SELECT count(updated_text) > 0 FROM {_PADDED} WHERE \"timestamp\" IS NOT NULL)"


@query(
    "p8_time_guard",
    sql(
        f"""SELECT event_id, "timestamp", updated_timestamp FROM {_PADDED}
            WHERE "timestamp" IS NOT NULL AND (NOT {_HAS} OR updated_timestamp IS NOT NULL)""",
        "lines",
    ),
)
def time_guard(spark, sf_dir):
    rows = clean.valid_times(_padded(spark, sf_dir))
    return rows.select("event_id", "timestamp", "updated_timestamp")


@query(
    "p8_time_guard_without_column",
    sql(
        f"""SELECT event_id, "timestamp" FROM {_PADDED} WHERE "timestamp" IS NOT NULL""",
        "lines",
    ),
)
def time_guard_without_column(spark, sf_dir):
    rows = _padded(spark, sf_dir).withColumn("updated_text", F.lit(None).cast("string"))
    return clean.valid_times(rows).select("event_id", "timestamp")


@query(
    "p9_today_only",
    sql(
        """SELECT mote_id, updated_timestamp FROM sparse WHERE CAST(updated_timestamp AS DATE) =
           (SELECT CAST(max(updated_timestamp) AS DATE) FROM sparse)""",
        "sparse",
    ),
)
def today_only(spark, sf_dir):
    rows = clean.on_day(tables.sparse(spark, sf_dir), tables.moved_clock(spark, sf_dir))
    return rows.select("mote_id", "updated_timestamp")


def _guard_sql(condition):
    return sql(f"SELECT event_id FROM {_PADDED} WHERE {condition}", "lines")


@query("p10_require_climate", _guard_sql("temperature IS NOT NULL AND humidity IS NOT NULL"))
def require_climate(spark, sf_dir):
    return clean.require_climate(_padded(spark, sf_dir)).select("event_id")


@query("p11_drop_empty", _guard_sql("coalesce(temperature, humidity, light, voltage) IS NOT NULL"))
def drop_empty(spark, sf_dir):
    return clean.drop_empty(_padded(spark, sf_dir)).select("event_id")


@query("p11_drop_empty_climate", _guard_sql("coalesce(temperature, humidity) IS NOT NULL"))
def drop_empty_climate(spark, sf_dir):
    rows = clean.drop_empty(_padded(spark, sf_dir), ("temperature", "humidity"))
    return rows.select("event_id")


@query(
    "p12_require_all",
    _guard_sql(" AND ".join(f"{m} IS NOT NULL" for m in METRICS)),
)
def require_all(spark, sf_dir):
    return clean.require_all(_padded(spark, sf_dir)).select("event_id")


@query(
    "a28_parse_report",
    sql(
        f"""SELECT reason, count(*) AS n_rows, count(*) * CAST(100 AS DOUBLE) /
              (SELECT count(*) FROM lines) AS percent
            FROM (SELECT CASE WHEN mote_id IS NULL THEN 'mote id is no number'
                WHEN NOT mote_id BETWEEN 1 AND 100 THEN 'mote id out of range'
                WHEN "timestamp" IS NULL THEN 'no recorded time'
                WHEN updated_timestamp IS NULL THEN 'no remapped time'
                WHEN temperature IS NULL OR humidity IS NULL THEN 'no temperature or humidity'
                ELSE 'kept' END AS reason FROM {_PADDED}) GROUP BY 1""",
        "lines",
    ),
)
def parse_report(spark, sf_dir):
    return clean.parse_report(_padded(spark, sf_dir), clean.drop_reason)


@query(
    "a28_ragged_report",
    sql(
        f"""SELECT coalesce(reject, 'kept') AS reason, count(*) AS n_rows,
            count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM lines) AS percent
            FROM ({_ragged_sql("len(t) = 9")}) GROUP BY 1""",
        "lines",
    ),
)
def ragged_report(spark, sf_dir):
    parsed = sources.parse_ragged(tables.lines(spark, sf_dir))
    return clean.parse_report(parsed, lambda df: F.col("reject"))


_CLEAN = f"""(SELECT CAST(trunc(mote_id) AS INTEGER) AS mote_id, epoch, "timestamp",
      updated_timestamp, temperature, humidity, coalesce(light, 0) AS light, voltage
    FROM {_PADDED} WHERE mote_id BETWEEN 1 AND 100 AND "timestamp" IS NOT NULL
      AND updated_timestamp IS NOT NULL AND temperature IS NOT NULL AND humidity IS NOT NULL)"""


@query(
    "d8_clean_readings",
    sql(
        f"""SELECT mote_id, epoch, "timestamp", updated_timestamp, temperature, humidity, light,
            coalesce(forward, first_value(forward IGNORE NULLS) OVER (ORDER BY mote_id,
              "timestamp", epoch ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS voltage
            FROM (SELECT *, last_value(voltage IGNORE NULLS) OVER (PARTITION BY mote_id
              ORDER BY "timestamp", epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS forward FROM {_CLEAN})""",
        "lines",
    ),
)
def clean_readings(spark, sf_dir):
    rows = clean.clean_readings(_padded(spark, sf_dir))
    return rows.drop("event_id")


@query(
    "f1_tokens",
    sql(
        f"SELECT event_id, len(t) AS n_tokens, t[1] AS first, t[-1] AS last FROM {_T}",
        "lines",
    ),
)
def tokens(spark, sf_dir):
    lines = text.with_tokens(tables.lines(spark, sf_dir), "t")
    return lines.select(
        "event_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.col("t")[0].alias("first"),
        F.element_at("t", -1).alias("last"),
    )


@query(
    "f4_iso_times",
    sql(
        f"""SELECT event_id, {sql_iso('t[-1]')} AS converted,
            {sql_iso('t[-1]', convert=False)} AS unshifted FROM {_T}""",
        "lines",
    ),
)
def iso_times(spark, sf_dir):
    last = F.element_at("t", -1)
    return text.with_tokens(tables.lines(spark, sf_dir), "t").select(
        "event_id",
        times.iso_time(last).alias("converted"),
        times.iso_time_unshifted(last).alias("unshifted"),
    )


# Line remapping ------------------------------------------------------------

_AS_OF = datetime(2026, 2, 10, 8, 30)
_LAST = f"CASE WHEN len(t) IN (4, 9) THEN {sql_iso('t[-1]', convert=False)} END"


def _rewritten_sql(new, source):
    return f"""SELECT event_id, new IS NOT NULL AS changed, CASE WHEN new IS NULL THEN line
        ELSE regexp_replace(line, '\\s+\\S+\\s*$', ' ' || new) END AS line
        FROM (SELECT event_id, line, strftime({new}, '%Y-%m-%dT%H:%M:%S.%f') AS new FROM {source})"""


@query(
    "r4_remap_historical",
    sql(
        _rewritten_sql(
            f"""{_LAST} + to_days(date_diff('day', (SELECT max(CAST({_LAST} AS DATE)) FROM {_T}),
            DATE '2026-02-09'))""",
            _T,
        ),
        "lines",
    ),
)
def remap_historical(spark, sf_dir):
    return remap.remap_historical_lines(tables.lines(spark, sf_dir), _AS_OF)


_MAP = f"""(SELECT d, DATE '2026-02-10' + CAST(dense_rank() OVER (ORDER BY d) - 1 AS INTEGER) AS n
    FROM (SELECT DISTINCT TRY_CAST(t[1] AS DATE) AS d FROM {_T} WHERE len(t) >= 4)
    WHERE d IS NOT NULL)"""


@query(
    "r5_remap_incremental",
    sql(
        _rewritten_sql(
            f"(CAST(m.n AS TIMESTAMP) + ({_LAST} - date_trunc('day', {_LAST})))",
            f"{_T} l LEFT JOIN {_MAP} m ON TRY_CAST(l.t[1] AS DATE) = m.d",
        ),
        "lines",
    ),
)
def remap_incremental(spark, sf_dir):
    return remap.remap_incremental_lines(tables.lines(spark, sf_dir), _AS_OF)


@query(
    "w4_date_map",
    sql(f"SELECT d AS orig_date, n AS new_date FROM {_MAP}", "lines"),
)
def date_map(spark, sf_dir):
    return remap.date_map(tables.lines(spark, sf_dir), _AS_OF)


@query(
    "r6_changed_lines",
    sql(
        f"""SELECT len(t) AS n_tokens, count(*) AS n_lines, count({_LAST}) AS n_changed
            FROM {_T} GROUP BY 1""",
        "lines",
    ),
)
def changed_lines(spark, sf_dir):
    remapped = remap.remap_historical_lines(tables.lines(spark, sf_dir), _AS_OF)
    size = F.size(text.tokens(F.col("line"))).cast("bigint")
    return remapped.groupBy(size.alias("n_tokens")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("changed").alias("n_changed")
    )


_DATES = f"""(SELECT CAST({sql_recorded('t[1]', 't[2]')} AS DATE) AS date FROM {_T}
    WHERE {sql_recorded('t[1]', 't[2]')} IS NOT NULL)"""
_ANCHOR = f"""(SELECT min(date) + CAST(floor((date_diff('day', min(date), max(date)) + 1)
    * CAST(0.8 AS DOUBLE)) AS INTEGER) FROM {_DATES})"""
_PREVIEW = f"""(SELECT date, DATE '2026-02-10' + CAST(date_diff('day', {_ANCHOR}, date) AS INTEGER)
      AS new_date, count(*) AS n_rows, date_diff('day', {_ANCHOR}, date) AS o
    FROM {_DATES} GROUP BY date)"""


def _preview(spark, sf_dir):
    path = scratch_path(spark, "lines")
    tables.lines(spark, sf_dir).select("line").write.text(path)
    return remap.mapping_preview(sources.read_dates(spark, path), _AS_OF)


@query(
    "r7_mapping_preview",
    sql(
        f"""SELECT date, new_date, n_rows, CASE WHEN o = 0 THEN 'today'
            WHEN o < 0 THEN -o || ' days ago' ELSE o || ' days in future' END AS label
            FROM {_PREVIEW}""",
        "lines",
    ),
)
def mapping_preview(spark, sf_dir):
    return _preview(spark, sf_dir)


@query(
    "a17_mapping_outcome",
    sql(
        f"""SELECT CAST(sum(n_rows) AS BIGINT) AS n_rows,
            CAST(coalesce(sum(CASE WHEN o <= 0 THEN n_rows END), 0) AS BIGINT) AS n_kept,
            CAST(coalesce(sum(CASE WHEN o > 0 THEN n_rows END), 0) AS BIGINT) AS n_future
            FROM {_PREVIEW}""",
        "lines",
    ),
)
def mapping_outcome(spark, sf_dir):
    return remap.mapping_outcome(_preview(spark, sf_dir), _AS_OF)
