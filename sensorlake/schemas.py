"""Column names, explicit schemas and fixed value tables shared by the package."""

from pyspark.sql import types as T

MEASUREMENT = "sensor_reading"
METRICS = ("temperature", "humidity", "light", "voltage")
PARTITIONS = ("year", "month", "day")

_METRIC_FIELDS = [T.StructField(m, T.DoubleType()) for m in METRICS]

# One row per reading. ``timestamp`` is the recording time, ``updated_timestamp``
# the remapped one that serves as event time downstream.
READING = T.StructType(
    [
        T.StructField("mote_id", T.IntegerType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("updated_timestamp", T.TimestampNTZType()),
        *_METRIC_FIELDS,
    ]
)

# One row per metric value, the layout of the hot store.
POINT = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("mote_id", T.StringType()),
        T.StructField("_field", T.StringType()),
        T.StructField("_value", T.DoubleType()),
        T.StructField("_time", T.TimestampNTZType()),
    ]
)

# JSON message body; times travel as ISO text.
MESSAGE = T.StructType(
    [
        T.StructField("mote_id", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("updated_timestamp", T.StringType()),
        T.StructField("original_timestamp", T.StringType()),
        *_METRIC_FIELDS,
        T.StructField("epoch", T.LongType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("mote_id", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

_PARTITION_FIELDS = [T.StructField(p, T.StringType()) for p in PARTITIONS]

# Archive laid out by day and mote, and the typed archive with one folder per day.
# Partition values are read as text so that ``month=02`` keeps its zero.
MOTE_ARCHIVE = T.StructType(
    [
        T.StructField("epoch", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("updated_timestamp", T.TimestampNTZType()),
        *_METRIC_FIELDS,
        *_PARTITION_FIELDS,
        T.StructField("mote_id", T.IntegerType()),
    ]
)
DAILY_ARCHIVE = T.StructType(
    [
        T.StructField("mote_id", T.IntegerType()),
        *[T.StructField(m, T.FloatType()) for m in METRICS],
        T.StructField("timestamp", T.StringType()),
        T.StructField("updated_timestamp", T.StringType()),
        *_PARTITION_FIELDS,
    ]
)

# Fixed values ---------------------------------------------------------------

MOTE_ID_RANGE = (1, 100)

# Physically possible values; rows outside never reach the model.
PHYSICS_BOUNDS = {
    "temperature": (-10.0, 80.0),
    "humidity": (0.0, 100.0),
    "light": (0.0, 3000.0),
    "voltage": (0.0, 5.0),
}

# Plausible values for reports.
VALID_RANGES = {
    "temperature": (-10.0, 50.0),
    "humidity": (0.0, 100.0),
    "light": (0.0, 5000.0),
    "voltage": (2.0, 3.5),
}

# Comfort limits and penalty of the rule-based score.
RULES = {
    "temperature": (15.0, 45.0, 0.4),
    "humidity": (20.0, 90.0, 0.3),
    "light": (0.0, 2000.0, 0.2),
    "voltage": (2.0, 3.5, 0.3),
}
RULE_ALARM = 0.3
SEVERITY = (("critical", 0.65), ("warning", 0.5))

# Usual values for a metric column that is absent from a scan.
USUAL = {"temperature": 22.0, "humidity": 50.0, "light": 100.0, "voltage": 2.9}

# Readings that a model is probed with: name and the four metrics.
PROBES = (
    ("normal_1", 22.5, 55.0, 300.0, 2.9),
    ("normal_2", 20.0, 60.0, 200.0, 3.0),
    ("normal_3", 25.0, 50.0, 400.0, 2.8),
    ("zeros", 0.0, 0.0, 0.0, 0.0),
    ("extreme", 95.0, 2.0, 0.0, 0.1),
)

FEATURES = (*METRICS, "hour", "day_of_week")
