"""Feature preparation and scaling for the anomaly model."""

from pyspark.sql import functions as F

from sensorlake.functions import times
from sensorlake.operators.clean import coerce_metrics, drop_empty, within_physics
from sensorlake.operators.slices import ROWS_PER_SLICE, exact_quantiles, positions
from sensorlake.schemas import FEATURES, METRICS
from sensorlake.session import written

#: Draws are numbers of 52 bits.
HASHES = 1 << 52
#: Rows of a file of prepared features: some seconds of scoring.
ROWS_PER_FILE = 500_000


def time_features(df):
    """Hour and weekday (Monday 0) of the remapped time if that column exists, else of
    the recorded time; without any time column noon on a Monday."""
    column = next((c for c in ("updated_timestamp", "timestamp") if c in df.columns), None)
    if column is None:
        return df.withColumns({"hour": F.lit(12.0), "day_of_week": F.lit(0.0)})
    moment = F.col(column)
    if dict(df.dtypes)[column] == "string":
        moment = times.iso_time(moment)
    return df.withColumns(
        {
            "hour": F.hour(moment).cast("double"),
            "day_of_week": times.day_of_week(moment).cast("double"),
        }
    )


def medians(df, columns=FEATURES, rows_per_slice=ROWS_PER_SLICE):
    """Exact median per column as a dict; columns without values are absent."""
    present = [c for c in columns if c in df.columns]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in present]).unpivot(
        [], present, "_field", "_value"
    )
    rows = exact_quantiles(long, ["_field"], "_value", [0.5], rows_per_slice).collect()
    return {r["_field"]: r["quantiles"][0] for r in rows}


def prepare_features(
    readings, keep=("mote_id",), rows_per_slice=ROWS_PER_SLICE, rows_per_file=ROWS_PER_FILE
):
    """Six double columns ready for the model, plus the columns to keep.

    Rows without any metric and rows with impossible values are dropped; what is
    still missing becomes the column's median, ranked only for columns that need it.
    A metric column that is absent altogether is left out. The rows are written once to
    the shared folder: the source is read once, whatever follows. Files of bounded size
    spread what follows over all tasks, even if the source is one large row group.
    """
    present = [m for m in METRICS if m in readings.columns]
    if not present:
        raise ValueError(f"none of the columns {METRICS} is there")
    rows = within_physics(time_features(drop_empty(coerce_metrics(readings), present)))
    columns = feature_columns(rows)
    rows = written(rows.select(*keep, *columns), "features", rows_per_file)
    holes = rows.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if holes[c]]
    return rows.fillna(medians(rows, missing, rows_per_slice)) if missing else rows


def feature_columns(df):
    """The feature columns that a frame has."""
    return tuple(c for c in FEATURES if c in df.columns)


def scaling(features, columns=FEATURES):
    """Row count, and mean and population deviation per column; a constant divides by 1."""
    row = features.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return row["n"], {c: (row[f"mean_{c}"], row[f"std_{c}"] or 1.0) for c in columns}


def scaled(features, scale):
    """Columns with their mean removed, in units of their deviation."""
    return features.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in scale.items()}
    )


def draw_of(key, seed=42):
    """A row's number between 0 and ``HASHES`` in a draw, by its key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def seeded_sample(df, n, key, seed=42, rows_per_slice=ROWS_PER_SLICE):
    """n rows without replacement, the same ones for any partitioning.

    The rows with the n smallest hashes of their key are drawn. A bound on the hash
    leaves little more than n candidates, which are then numbered in hash order; if
    the bound should ever leave too few, all rows are numbered. The key should be
    unique, as equal keys follow each other.
    """
    hashed = df.withColumn("_draw", draw_of(key, seed))
    total = df.count()
    share = min(1.0, (n + 6 * n**0.5 + 100) / max(total, 1))
    candidates = hashed.filter(F.col("_draw") < int(share * HASHES))
    if share < 1.0 and candidates.count() < n:
        candidates = hashed
    order = ["_draw", *key]
    numbered = positions(candidates, [], "_draw", order, "_position", rows_per_slice)
    return numbered.filter(F.col("_position") < n).select(*df.columns)
