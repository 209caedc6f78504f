"""Time series, remapping, profiles and lookups on small frames."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators import clean, joins, profile, remap, timeseries
from sensorlake.schemas import METRICS
from sensorlake.sources import text

AS_OF = datetime(2026, 2, 10, 12, 0)


def points(spark, *rows):
    return spark.createDataFrame(
        rows, "mote_id string, _field string, _value double, minutes_ago double"
    ).select(
        F.lit("sensor_reading").alias("measurement"),
        "mote_id",
        "_field",
        "_value",
        (times.at(AS_OF) - F.make_dt_interval(secs=F.col("minutes_ago") * 60)).alias("_time"),
    )


def test_bounds():
    assert times.bound("-1h30m", AS_OF) == AS_OF - timedelta(minutes=90)
    assert times.bound("now()", AS_OF) == AS_OF
    assert times.bound(0, AS_OF) == datetime(1970, 1, 1)
    assert times.bound("2026-02-01T02:00:00+02:00", AS_OF) == datetime(2026, 2, 1)
    for bad in ("-1x", "yesterday", ""):
        with pytest.raises(ValueError):
            times.bound(bad, AS_OF)


def test_start_is_inside_and_stop_is_not(spark):
    df = points(spark, ("1", "light", 1.0, 60.0), ("1", "light", 2.0, 0.0), ("1", "light", 3.0, 61.0))
    assert [r["_value"] for r in timeseries.select_points(df, AS_OF, "-1h").collect()] == [1.0]


def test_range_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = events.filter(times.in_range("ts", "-1d", datetime(2024, 1, 20))).select("value")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_mean_of_means_differs_from_mean(spark):
    df = points(spark, *[("1", "light", 10.0, m) for m in (1.0, 2.0, 3.0)], ("2", "light", 20.0, 1.0))
    assert timeseries.metric_summary(df, "light", AS_OF).first()["mean"] == 12.5
    assert timeseries.mean_of_means(df, "light", AS_OF).first()["mean"] == 15.0


def test_empty_window(spark):
    row = timeseries.metric_summary(points(spark, ("1", "light", 1.0, 1.0)), "voltage", AS_OF).first()
    assert tuple(row) == ("voltage", None, None, None, 0)


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        timeseries.metric_summary(points(spark, ("1", "light", 1.0, 1.0)), "pressure", AS_OF)


def test_fields_with_other_last_times(spark):
    df = points(
        spark, ("1", "light", 1.0, 5.0), ("1", "voltage", 2.0, 5.0), ("1", "light", 9.0, 1.0)
    )
    rows = timeseries.latest_points(df, AS_OF).orderBy("_time").collect()
    assert [(r["light"], r["voltage"]) for r in rows] == [(None, 2.0), (9.0, None)]
    one = timeseries.latest_reading(df, AS_OF).collect()
    assert [(r["light"], r["voltage"]) for r in one] == [(9.0, 2.0)]


def test_text_order_of_motes(spark):
    df = points(spark, *[(m, "light", 1.0, 1.0) for m in ("2", "10", "1")])
    assert [r[0] for r in timeseries.mote_list(df, AS_OF).collect()] == ["1", "10", "2"]


def test_history_limit(spark):
    df = points(spark, *[("1", "light", float(m), float(m)) for m in range(1, 6)])
    got = timeseries.history(df, 1, AS_OF, limit=2).collect()
    assert [r["light"] for r in got] == [5.0, 4.0]
    for limit in (0, 5001):
        with pytest.raises(ValueError):
            timeseries.history(df, 1, AS_OF, limit=limit)


def test_wide_long_wide(spark):
    df = points(
        spark, ("1", "light", 1.0, 5.0), ("1", "voltage", 2.0, 5.0), ("2", "humidity", 9.0, 1.0)
    )
    wide = timeseries.to_readings(df)
    again = timeseries.to_readings(timeseries.to_points(wide, "_time"))
    assert sorted(map(str, again.collect())) == sorted(map(str, wide.collect()))


def test_limit_per_series_is_taken_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as mote_id", "id as _time")
    first = timeseries.first_per_series(df, 2)
    assert first.count() == 6
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def lines(spark, *rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, line string")


def test_remap_historical_lines(spark):
    full = "2013-11-04 17:20:41.75 58 6 23.5 61.25 310.0 2.5 2030-05-22T17:20:41.5Z"
    sparse = "  2013-11-04 17:21:08.6  6 2030-05-23T08:30:11"
    other = "2013-11-04 17:21:08.6 6 garbage"
    eight = "2013-11-04 17:20:41.75 58 6 23.5 61.25 310.0 2030-09-22T17:20:41.5"
    got = remap.remap_historical_lines(lines(spark, full, sparse, other, eight), AS_OF).orderBy("i")
    rows = got.collect()
    assert rows[0]["line"].endswith(" 2.5 2026-02-08T17:20:41.500000")
    assert rows[1]["line"] == "  2013-11-04 17:21:08.6  6 2026-02-09T08:30:11.000000"
    assert [r["line"] for r in rows[2:]] == [other, eight]
    assert [r["changed"] for r in rows] == [True, True, False, False]


def test_remap_incremental_lines(spark):
    line = "{} 21:14:02.9 5 2019-06-03T19:03:19"
    days = ("2004-03-09", "2004-02-28", "2004-03-01", "2004-02-28")
    got = remap.remap_incremental_lines(lines(spark, *map(line.format, days)), AS_OF).orderBy("i")
    last = [r["line"].split()[-1][:16] for r in got.collect()]
    assert last == [f"2026-02-{d}T19:03" for d in (12, 10, 11, 10)]


def test_shift_keeps_order_and_gaps(spark):
    start = datetime(2004, 2, 28)
    stamps = [start + timedelta(seconds=37 * i * i, microseconds=i) for i in range(50)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, s timestamp_ntz")
    historical, incremental = remap.to_present(df, "s", AS_OF)
    assert historical.count() + incremental.count() == 50
    for part, edge in ((historical, max), (incremental, min)):
        rows = part.orderBy("i").collect()
        offsets = {r["updated_timestamp"] - r["s"] for r in rows}
        assert len(offsets) == 1
        moved = edge(r["updated_timestamp"] for r in rows)
        assert moved == (AS_OF if edge is max else AS_OF + timedelta(minutes=1))
    cut = start + int((stamps[-1] - start) / timedelta(microseconds=1) * 0.8) * timedelta(microseconds=1)
    assert historical.agg(F.max("s")).first()[0] <= cut < incremental.agg(F.min("s")).first()[0]


def test_leap_day(spark):
    df = spark.sql("select timestamp_ntz'2004-02-29 10:11:12.5' as timestamp, "
                   "cast(null as timestamp_ntz) as updated_timestamp")
    row = remap.with_fallback_time(df, 22).first()
    assert row["updated_timestamp"] == datetime(2026, 2, 28, 10, 11, 12, 500000)


def test_mapping_preview(spark):
    df = spark.sql("select date_add(date'2004-02-28', cast(id as int)) as date from range(10)")
    rows = remap.mapping_preview(df, AS_OF).orderBy("date").collect()
    assert rows[8]["label"] == "today" and rows[8]["new_date"] == AS_OF.date()
    assert rows[7]["label"] == "1 days ago" and rows[9]["label"] == "1 days in future"
    outcome = remap.mapping_outcome(remap.mapping_preview(df, AS_OF), AS_OF).first()
    assert tuple(outcome) == (10, 9, 1)


def test_line_positions_over_files(spark, tmp_path):
    for name, start in (("b", 1500), ("a", 0), ("c", 1600)):
        body = "".join(f"{i}\n" for i in range(start, {0: 1500, 1500: 1600, 1600: 4000}[start]))
        (tmp_path / name).write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = text.numbered_lines(spark, str(tmp_path))
        assert got.filter("cast(line as long) <> position").count() == 0
        historical, rest = remap.split_lines(spark, str(tmp_path))
        assert (historical.count(), rest.count()) == (3200, 800)
        assert historical.agg(F.max("position")).first()[0] == 3199
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_replay(spark):
    df = spark.sql(
        "select 1 as mote_id, cast(id as long) as epoch, timestamp_ntz'2004-03-01 00:00:00' + "
        "make_dt_interval(0, 0, 0, cast(id * id as decimal(18, 6))) as timestamp from range(4)"
    )
    for limit in (2, 1000):
        rows = remap.replay_schedule(df, 10.0, rows_per_slice=limit).orderBy("epoch").collect()
        assert [r["gap_seconds"] for r in rows] == [0.0, 1.0, 3.0, 5.0]
        assert [r["replay_seconds"] for r in rows] == [0.0, 0.1, 0.4, 0.9]


def test_clean_readings(spark):
    line = "2004-03-01 10:0{}:00.0 {} {} 20.0 {} ? {} 2026-02-10T1{}:00:00"
    df = spark.createDataFrame(
        [
            (line.format(0, 1, 1, 40, "?", 0),),
            (line.format(1, 2, 1, 41, 2.5, 1),),
            (line.format(2, 3, 1, "?", 2.6, 2),),
            (line.format(3, 4, 101, 42, 2.6, 3),),
            (line.format(4, 5, 2, 43, "?", 0).replace("2026-02-10", "2026-02-11"),),
        ],
        "line string",
    )
    parsed = text.parse_readings(df)
    rows = clean.clean_readings(parsed, as_of=AS_OF).orderBy("epoch").collect()
    assert [(r["epoch"], r["light"], r["voltage"]) for r in rows] == [(1, 0.0, 2.5), (2, 0.0, 2.5)]
    assert clean.clean_readings(parsed).count() == 3
    assert clean.clean_readings(parsed).filter("temperature is null or humidity is null").count() == 0


def test_per_mote_order(spark):
    df = spark.range(100).selectExpr("id % 7 as mote_id", "100 - id as timestamp", "id as epoch")
    ordered = clean.per_mote_order(df).collect()
    keys = [(r["mote_id"], r["timestamp"]) for r in ordered]
    assert keys == sorted(keys)


def readings(spark, *rows):
    return spark.createDataFrame(rows, "mote_id int, t string, temperature double, humidity double, "
                                 "light double, voltage double").selectExpr(
        "mote_id", "cast(t as timestamp_ntz) as timestamp", *METRICS)


def test_reports(spark):
    df = readings(
        spark,
        (1, "2026-02-09 01:00:00", 60.0, 50.0, 1.0, 2.5),
        (1, "2026-02-10 02:00:00", 20.0, None, 1.0, 1.0),
        (2, "2026-02-10 12:00:00.1", 20.0, 50.0, None, None),
    )
    check = profile.remap_check(df, AS_OF, "timestamp").first()
    assert tuple(check) == (3, 0, 2, 1, 1, 2, False)
    unread = df.withColumn("timestamp", F.when(F.col("mote_id") < 0, F.col("timestamp")))
    check = profile.remap_check(unread, AS_OF, "timestamp").first()
    assert (check["n_rows"], check["n_errors"], check["passed"]) == (0, df.count(), False)
    assert profile.remap_check(df.limit(0), AS_OF, "timestamp").first()["passed"] is False
    outside = {r["field"]: (r["n"], r["n_outside"]) for r in profile.out_of_range(df).collect()}
    assert outside["temperature"] == (3, 1) and outside["voltage"] == (2, 1)
    rates = {r["metric"]: (round(r["null_percent"]), r["ok"]) for r in profile.null_rates(df).collect()}
    assert rates["temperature"] == (0, True) and rates["light"] == (33, False)
    assert tuple(profile.kpis(df).first()) == (3, 2, date(2026, 2, 9), date(2026, 2, 10))
    top = profile.date_distribution(df, "timestamp", 1).first()
    assert (top["date"], top["n_rows"], round(top["percent"], 2)) == (date(2026, 2, 10), 2, 66.67)
    assert profile.between_dates(df, date(2026, 2, 9), date(2026, 2, 9)).count() == 1


def test_weekday_is_monday_first(spark):
    df = readings(spark, (1, "2026-02-09 05:00:00", 20.0, 1.0, 1.0, 1.0), (1, "2026-02-15 05:30:00", 30.0, 1.0, 1.0, 1.0))
    rows = profile.weekday_hour(df, "temperature").collect()
    assert [(r["day_of_week"], r["day_name"], r["h05"], r["h06"]) for r in rows] == [
        (0, "Monday", 20.0, None), (6, "Sunday", 30.0, None)]


def test_freshness(spark):
    df = points(spark, ("1", "light", 1.0, 59.0))
    assert timeseries.freshness(df, AS_OF).first()["fresh"]
    assert not timeseries.freshness(df, AS_OF + timedelta(minutes=1)).first()["fresh"]


def test_location_lookup(spark):
    locations = spark.createDataFrame([(1, 2.0, 3.0)], "mote_id int, x double, y double")
    rows = spark.createDataFrame([(1,), (2,)], "mote_id int")
    got = {r["mote_id"]: r["x"] for r in joins.with_location(rows, locations).collect()}
    assert got == {1: 2.0, 2: None}
    assert joins.location_of(locations, 9).count() == 0


def test_mote_count(spark):
    df = spark.range(200).selectExpr("id % 43 as mote_id")
    assert tuple(timeseries.mote_count_check(df).first()) == (43, True)


def test_no_rows(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, date date")
    assert remap.split_time(df, "ts") is None
    assert [part.count() for part in remap.range_split(df, "ts")] == [0, 0]
    assert [part.count() for part in remap.to_present(df, "ts", AS_OF)] == [0, 0]
    assert remap.mapping_preview(df.select("date"), AS_OF).count() == 0
