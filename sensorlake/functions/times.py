"""Columns and driver-side values for event time."""

import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

_RECORDED = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$"
_ZONE = r"(?:Z|[+-]\d\d:?\d\d)$"
_ISO = r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?)?$"
_ISO_ZONED = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:?\d\d)$"

_UNITS = {
    "us": timedelta(microseconds=1),
    "ms": timedelta(milliseconds=1),
    "s": timedelta(seconds=1),
    "m": timedelta(minutes=1),
    "h": timedelta(hours=1),
    "d": timedelta(days=1),
    "w": timedelta(weeks=1),
}


def at(moment):
    """A literal without zone for a ``datetime``; it reaches the scan as a pushed filter."""
    return F.expr(f"timestamp_ntz'{moment.isoformat(sep=' ', timespec='microseconds')}'")


def day(date):
    """A date literal."""
    return F.expr(f"date'{date.isoformat()}'")


def duration(text):
    """``-1h30m`` or ``15m`` as a timedelta."""
    sign = -1 if text.startswith("-") else 1
    body = text.lstrip("+-")
    parts = re.findall(r"(\d+)(us|ms|s|m|h|d|w)", body)
    if not parts or "".join(n + u for n, u in parts) != body:
        raise ValueError(f"not a duration: {text!r}")
    return sign * sum((int(n) * _UNITS[u] for n, u in parts), timedelta())


def bound(spec, as_of):
    """A range bound: a datetime, ``now()``, ``0``, a duration from ``as_of`` or ISO text."""
    if isinstance(spec, datetime):
        return spec
    if isinstance(spec, timedelta):
        return as_of + spec
    if spec == "now()":
        return as_of
    if spec in (0, "0"):
        return datetime(1970, 1, 1)
    try:
        return as_of + duration(spec)
    except ValueError:
        pass
    moment = datetime.fromisoformat(spec)
    if moment.tzinfo is not None:
        moment = (moment - moment.utcoffset()).replace(tzinfo=None)
    return moment


def in_range(column, start, as_of, stop="now()"):
    """``start <= column < stop`` with literal bounds."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= at(bound(start, as_of))) & (column < at(bound(stop, as_of)))


def recorded_time(date, time):
    """Date and time tokens as one timestamp; the fraction of 1 to 6 digits is required."""
    text = F.concat_ws(" ", date, time)
    return F.when(text.rlike(_RECORDED), text).try_cast("timestamp_ntz")


def iso_time(text):
    """ISO text as UTC wall time; an offset is converted, a missing zone means UTC."""
    wall = F.regexp_replace(text, _ZONE, "").try_cast("timestamp_ntz")
    zone = F.regexp_extract(text, _ZONE, 0)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = (
        F.coalesce(F.substring(digits, start, 2).try_cast("int"), F.lit(0)) for start in (1, 3)
    )
    shifted = wall - F.make_dt_interval(mins=sign * (hours * 60 + minutes))
    return F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz")).when(
        text.rlike(_ISO_ZONED), shifted
    )


def iso_time_unshifted(text):
    """ISO text with ``Z`` or a ``+`` offset cut off, not converted."""
    plain = F.split(F.regexp_replace(text, "Z$", ""), r"\+")[0]
    return F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz")).when(
        text.rlike(_ISO_ZONED), plain.try_cast("timestamp_ntz")
    )


def iso_text(moment):
    """ISO text with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def message_time_text(moment):
    """ISO text that leaves the fraction out when it is zero."""
    return F.regexp_replace(iso_text(moment), r"\.000000$", "")


def micros(moment):
    """Microseconds since 1970 as bigint; orders rows and measures gaps."""
    return F.unix_micros(moment.cast("timestamp"))


def event_time(updated="updated_timestamp", recorded="timestamp"):
    """The remapped time, else the recorded one; empty text counts as missing."""
    return F.coalesce(
        F.when(F.col(updated).cast("string") != "", F.col(updated)),
        F.when(F.col(recorded).cast("string") != "", F.col(recorded)),
    )


def day_of_week(moment):
    """Monday is 0."""
    return F.weekday(moment)


def day_name(moment):
    return F.date_format(moment, "EEEE")


def shift(moment, interval):
    """Move by an exact timedelta."""
    micro = interval // timedelta(microseconds=1)
    seconds, rest = divmod(micro, 1_000_000)
    days, seconds = divmod(seconds, 86_400)
    return moment + F.expr(f"make_dt_interval({days}, 0, 0, {seconds + rest / 1_000_000:.6f})")


def shift_days(moment, days):
    """Move by a whole number of days given as a column or an int."""
    days = F.lit(days) if isinstance(days, int) else days
    return moment + F.make_dt_interval(days=days)


def shift_years(moment, years):
    """Move by years; 29 February becomes the 28th where the year has no leap day."""
    years = F.lit(years) if isinstance(years, int) else years
    return moment + F.make_ym_interval(years=years)


def with_date(moment, date):
    """The time of day of ``moment`` on another date."""
    return date.cast("timestamp_ntz") + (moment - F.date_trunc("day", moment).cast("timestamp_ntz"))


def partition_values(moment):
    """Year, month and day as text; month and day have two digits."""
    return {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }


def latest_time(df, column):
    """One microsecond after the newest event time: the stop that still includes it."""
    newest = df.agg(F.max(column)).first()[0]
    return None if newest is None else newest + timedelta(microseconds=1)
