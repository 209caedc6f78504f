"""Text parsers on literal lines."""

from datetime import datetime

import pytest

from sensorlake.functions import times
from sensorlake.operators import clean
from sensorlake.sources import text
from pyspark.sql import functions as F

FULL = "2011-07-19 06:48:05.31724 812 9 17.25 63.5 88.0 2.75 2031-10-05T06:48:05.317240"
SPARSE = "2011-07-20 15:04:33.808017 9 2031-10-06T15:04:33.808017"
EIGHT = "2011-07-20 15:05:02.250001 70001 14 21.5 44.75 12.0 3.25"


def frame(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_full_line(spark):
    row = one(text.parse_readings(frame(spark, FULL)))
    assert row["mote_id"] == 9.0 and row["epoch"] == 812
    assert row["timestamp"] == datetime(2011, 7, 19, 6, 48, 5, 317240)
    assert row["updated_timestamp"] == datetime(2031, 10, 5, 6, 48, 5, 317240)
    assert (row["temperature"], row["voltage"]) == (17.25, 2.75)


def test_sparse_line(spark):
    lines = frame(spark, SPARSE)
    ragged = one(text.parse_ragged(lines))
    assert ragged["reject"] is None and ragged["mote_id"] == 9
    assert ragged["temperature"] is None
    assert ragged["updated_text"] == "2031-10-06T15:04:33.808017"
    assert one(text.parse_readings(lines))["mote_id"] is None


def test_line_without_remapped_time(spark):
    lines = frame(spark, EIGHT)
    assert one(text.parse_ragged(lines))["reject"] == "8 tokens"
    parsed = text.parse_readings(lines)
    assert clean.valid_times(parsed).count() == 1
    mixed = text.parse_readings(frame(spark, EIGHT, FULL))
    assert clean.valid_times(mixed).count() == 1


def test_too_long_line(spark):
    lines = frame(spark, FULL + " extra")
    assert one(text.parse_ragged(lines))["reject"] == "10 tokens"
    assert one(text.parse_ragged(lines, extra_tokens=True))["mote_id"] == 9
    assert text.parse_training(lines).count() == 0
    assert text.parse_raw(lines).count() == 0


def test_unknown_metrics(spark):
    line = "2011-07-19 06:48:05.31 812 9 19.9 ? 45.0 ? 2031-10-05T06:48:05.317240"
    for row in (one(text.parse_readings(frame(spark, line))), one(text.parse_ragged(frame(spark, line)))):
        assert row["humidity"] is None and row["voltage"] is None and row["light"] == 45.0


@pytest.mark.parametrize("token", ["19.x", "1d", "0x1p3", "--1"])
def test_bad_number(spark, token):
    lines = frame(spark, FULL.replace("17.25", token))
    assert one(text.parse_ragged(lines))["reject"] == "metric"
    assert one(text.parse_readings(lines))["temperature"] is None


def test_nan_is_null(spark):
    lines = frame(spark, FULL.replace("17.25", "NaN"))
    row = one(text.parse_ragged(lines))
    assert row["reject"] is None and row["temperature"] is None
    assert one(text.parse_readings(lines))["temperature"] is None


def test_fraction_is_required(spark):
    lines = frame(spark, FULL.replace("06:48:05.31724", "06:48:05"))
    assert one(text.parse_readings(lines))["timestamp"] is None
    assert text.parse_raw(lines).count() == 0


@pytest.mark.parametrize("mote", ["0", "101", "70001", "abc"])
def test_bad_mote(spark, mote):
    parsed = text.parse_readings(frame(spark, FULL.replace(" 812 9 ", f" 812 {mote} ")))
    assert clean.valid_mote_ids(parsed).count() == 0


def test_mote_as_decimal(spark):
    lines = frame(spark, FULL.replace(" 812 9 ", " 812 9.0 "))
    assert one(clean.valid_mote_ids(text.parse_readings(lines)))["mote_id"] == 9
    assert one(text.parse_ragged(lines))["mote_id"] == 9
    sparse = frame(spark, SPARSE.replace(" 9 ", " 9.0 "))
    assert one(text.parse_ragged(sparse))["reject"] == "mote id"


def test_iso_offsets(spark):
    df = spark.createDataFrame(
        [
            ("2026-01-17T00:59:16.5Z",),
            ("2026-01-17T01:59:16.5+02:00",),
            ("2026-01-17T01:59:16.5-0130",),
            ("2026-01-17",),
            ("soon",),
            ("2026-13-17T01:59:16",),
        ],
        "s string",
    )
    rows = df.select(times.iso_time(F.col("s")), times.iso_time_unshifted(F.col("s"))).collect()
    assert [r[0] for r in rows] == [
        datetime(2026, 1, 17, 0, 59, 16, 500000),
        datetime(2026, 1, 16, 23, 59, 16, 500000),
        datetime(2026, 1, 17, 3, 29, 16, 500000),
        datetime(2026, 1, 17),
        None,
        None,
    ]
    assert rows[1][1] == datetime(2026, 1, 17, 1, 59, 16, 500000)


def test_training_lines(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("\n".join(FULL.replace(" 812 9 ", f" {i} 9 ") for i in range(5)) + "\n")
    assert text.read_training(spark, str(path)).count() == 5


def test_locations(spark, tmp_path):
    (tmp_path / "l.txt").write_text("1 3.5 41\n2 8.25 7\n\n")
    rows = text.read_locations(spark, str(tmp_path / "l.txt")).collect()
    assert [tuple(r) for r in rows] == [(1, 3.5, 41.0), (2, 8.25, 7.0)]


def test_csv_columns(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    head = "date,time,epoch,{},temperature,humidity,light,voltage,updated_timestamp\n"
    row = "2011-07-19,06:48:05.31724,812,9,17.25,63.5,x,2.75,2031-10-05T06:48:05.317240\n"
    good.write_text(head.format("mote_id") + row)
    bad.write_text(head.format("moteid") + row)
    typed = one(text.csv_readings(text.read_csv(spark, str(good))))
    assert typed["temperature"] == 17.25 and typed["light"] is None
    with pytest.raises(ValueError, match="mote_id"):
        text.read_csv(spark, str(bad))


def test_dates_of_both_formats(spark, tmp_path):
    plain, csv = tmp_path / "p.txt", tmp_path / "c.csv"
    plain.write_text(FULL + "\nbad line\n")
    csv.write_text("date,moteid\n2011-07-19 06:48:05.31724,9\nnever,2\n")
    for path in (plain, csv):
        assert [str(r[0]) for r in text.read_dates(spark, str(path)).collect()] == ["2011-07-19"]


def test_written_text_reads_back(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = clean.valid_mote_ids(
        text.parse_readings(frame(spark, FULL, FULL.replace("63.5", "?")))
    )
    text.write_readings(rows, path)
    again = clean.valid_mote_ids(text.read_readings(spark, path))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
