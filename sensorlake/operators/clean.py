"""Row guards, imputation and parse reports."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions import text, times
from sensorlake.operators.slices import ROWS_PER_SLICE, forward_fill
from sensorlake.schemas import METRICS, MOTE_ID_RANGE, PHYSICS_BOUNDS, VALID_RANGES
from sensorlake.session import written


def coerce_metrics(df, columns=METRICS):
    """Metrics as doubles; text that is no number and NaN become null."""
    types = dict(df.dtypes)

    def coerced(c):
        if types[c] == "string":
            return text.number(F.col(c))
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({c: coerced(c) for c in columns if c in types})


def valid_mote_ids(df, column="mote_id", bounds=MOTE_ID_RANGE):
    """Rows whose id is a number within the bounds, with the id as int."""
    low, high = bounds
    return df.filter(F.col(column).between(low, high)).withColumn(
        column, text.truncated_id(F.col(column).cast("double"))
    )


def has_any(df, column):
    """Whether a column holds any value: one row comes back to the driver."""
    return bool(df.agg(F.max(F.col(column).isNotNull())).first()[0])


def valid_times(df, has_updated=None):
    """Rows with a recorded time and, if the data has remapped times at all, that too.

    ``updated_text`` keeps the unparsed remapped time; pass ``has_updated`` when it
    is known to save the pass that looks for any value.
    """
    timed = df.filter(F.col("timestamp").isNotNull())
    if has_updated is None:
        has_updated = has_any(timed, "updated_text")
    if has_updated:
        timed = timed.filter(F.col("updated_timestamp").isNotNull())
    return timed


def on_day(df, as_of, column="updated_timestamp"):
    """Rows dated on the day of ``as_of``; a half-open range, so that scans can skip."""
    start = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return df.filter(times.in_range(column, start, as_of, start + times.duration("1d")))


def require_climate(df):
    """Rows with both temperature and humidity."""
    return df.dropna(how="any", subset=["temperature", "humidity"])


def drop_empty(df, columns=METRICS):
    """Rows with at least one of the metrics."""
    return df.dropna(how="all", subset=list(columns))


def require_all(df, columns=METRICS):
    """Rows with every metric."""
    return df.dropna(how="any", subset=list(columns))


def within_physics(df, bounds=PHYSICS_BOUNDS):
    """Rows whose metrics are physically possible; null passes."""
    checks = [
        F.col(c).isNull() | F.col(c).between(low, high)
        for c, (low, high) in bounds.items()
        if c in df.columns
    ]
    return df.filter(reduce(and_, checks))


def out_of_valid_range(columns=METRICS):
    """Condition: some metric lies outside the range used for reports."""
    return reduce(or_, [~F.col(c).between(*VALID_RANGES[c]) for c in columns])


def dark_when_missing(df):
    """Missing light means darkness."""
    return df.fillna(0.0, subset=["light"])


def forward_fill_voltage(df, order=("timestamp", "epoch"), rows_per_slice=ROWS_PER_SLICE):
    """Carry the last known voltage forward per mote."""
    timed = df.withColumn("_at", times.micros(F.col("timestamp")))
    return forward_fill(
        timed, ["mote_id"], "_at", order, "voltage", None, rows_per_slice, order[1:]
    ).drop("_at")


def first_known_voltage(
    df, order=("timestamp", "epoch"), across_motes=True, rows_per_slice=ROWS_PER_SLICE
):
    """One row per mote with its earliest voltage.

    With ``across_motes`` a mote that never reports takes the first value of the
    next id that does: a forward fill over the ids from the last to the first, which is
    cut into slices of ids if there are many.
    """
    earliest = F.min_by(
        F.col("voltage"), F.when(F.col("voltage").isNotNull(), F.struct(*map(F.col, order)))
    )
    per_mote = df.groupBy("mote_id").agg(earliest.alias("first_voltage"))
    if not across_motes:
        return per_mote
    backward = written(per_mote.withColumn("_at", -F.col("mote_id")), "first-voltages")
    return forward_fill(
        backward, [], "_at", ["_at"], "first_voltage", None, rows_per_slice
    ).drop("_at")


def fill_voltage(
    df, order=("timestamp", "epoch"), cross_mote_backfill=True, rows_per_slice=ROWS_PER_SLICE
):
    """Forward fill per mote, then fill what is left from the first value that follows.

    After the forward fill only leading rows of a mote are null, so the value that
    follows is the mote's first, or the next mote's where it has none.
    """
    first = first_known_voltage(df, order, cross_mote_backfill, rows_per_slice)
    forward = forward_fill_voltage(df, order, rows_per_slice)
    return (
        forward.join(first, "mote_id", "left")
        .withColumn("voltage", F.coalesce("voltage", "first_voltage"))
        .select(*df.columns)
    )


def clean_readings(
    parsed, as_of=None, has_updated=None, cross_mote_backfill=True, rows_per_slice=ROWS_PER_SLICE
):
    """All guards and imputations in order: ids, times, day, climate, light, voltage.

    ``as_of`` keeps only rows remapped to that day; leave it out to keep every day.
    Guarded rows are written once, because the imputation reads them several times
    and text is slow to parse.
    """
    guarded = valid_mote_ids(parsed).filter(F.col("timestamp").isNotNull())
    rows = written(guarded, "guarded")
    if has_updated is None:
        has_updated = has_any(rows, "updated_text")
    rows = valid_times(rows, has_updated)
    if as_of is not None and has_updated:
        rows = on_day(rows, as_of)
    rows = dark_when_missing(require_climate(rows)).drop("updated_text")
    return fill_voltage(
        rows, cross_mote_backfill=cross_mote_backfill, rows_per_slice=rows_per_slice
    )


def per_mote_order(df, order=("timestamp", "epoch")):
    """Rows sorted by mote and time, spread by range so that a large mote spans tasks."""
    columns = ["mote_id", *order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def drop_reason(df, bounds=MOTE_ID_RANGE, has_updated=True):
    """Why the guards drop a row, null for a kept one."""
    low, high = bounds
    reason = F.when(F.col("mote_id").isNull(), "mote id is no number").when(
        ~F.col("mote_id").between(low, high), "mote id out of range"
    )
    reason = reason.when(F.col("timestamp").isNull(), "no recorded time")
    if has_updated:
        reason = reason.when(F.col("updated_timestamp").isNull(), "no remapped time")
    return reason.when(
        F.col("temperature").isNull() | F.col("humidity").isNull(), "no temperature or humidity"
    )


def parse_report(df, reason):
    """Rows and percent of all rows per drop reason; kept rows count as ``kept``.

    ``reason`` builds the reason column from the frame.
    """
    counts = df.groupBy(F.coalesce(reason(df), F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    total = F.sum("n_rows").over(W.partitionBy())
    return counts.select("reason", "n_rows", (F.col("n_rows") * 100.0 / total).alias("percent"))
