"""Model versions in the shared store: nodes, settings and a registry table."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from sensorlake.operators import forest as forests
from sensorlake.operators.features import prepare_features
from sensorlake.schemas import FEATURES
from sensorlake.sources.archive import recent_days

MIN_ROWS = 100

SETTINGS = "column string, mean double, std double, position int, offset double, sample int"
REGISTRY = (
    "version string, tag string, trained_at string, n_samples long, anomaly_ratio double, "
    "features array<string>, path string"
)


def version_name(trained_at, tag=None):
    return trained_at.strftime("%Y%m%d_%H%M%S") + (f"_{tag}" if tag else "")


def save_model(spark, base, forest, metrics, trained_at=None, tag=None):
    """Write a model under its version and register it; returns the version.

    ``metrics`` is the one row of training figures. The registry is appended last,
    so that it never names a model that is not there yet.
    """
    trained_at = trained_at or datetime.now(timezone.utc).replace(tzinfo=None)
    version = version_name(trained_at, tag)
    path = f"{base}/models/version={version}"
    spark.createDataFrame(list(forest.nodes), forests.NODES).coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/nodes")
    settings = [
        (c, *forest.scale[c], i, forest.offset, forest.sample)
        for i, c in enumerate(forest.columns)
    ]
    spark.createDataFrame(settings, SETTINGS).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/settings"
    )
    entry = (
        version, tag, trained_at.isoformat(), metrics["n_samples"], metrics["anomaly_ratio"],
        list(metrics["feature_names"]), path,
    )
    spark.createDataFrame([entry], REGISTRY).coalesce(1).write.mode("append").json(
        f"{base}/registry"
    )
    return version


def registry(spark, base):
    """All registered models; empty before the first."""
    try:
        return spark.read.schema(REGISTRY).json(f"{base}/registry")
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], REGISTRY)
        raise


def latest_entry(models):
    """The model trained last."""
    return models.orderBy(F.desc("trained_at"), F.desc("version")).limit(1)


def load_model(spark, path):
    nodes = tuple(spark.read.schema(forests.NODES).parquet(f"{path}/nodes").collect())
    settings = spark.read.schema(SETTINGS).parquet(f"{path}/settings").orderBy("position").collect()
    return forests.Forest(
        tuple(sorted(nodes, key=lambda n: (n["tree"], n["node"]))),
        {s["column"]: (s["mean"], s["std"]) for s in settings},
        settings[0]["offset"],
        settings[0]["sample"],
        tuple(s["column"] for s in settings),
    )


def load_latest(spark, base):
    """The model trained last, or None: the scan then falls back to the rules."""
    entry = latest_entry(registry(spark, base)).first()
    return None if entry is None else load_model(spark, entry["path"])


def model_info(spark, base):
    """One row: how many models there are, the latest, and whether rules are used."""
    models = registry(spark, base)
    return models.agg(
        F.count(F.lit(1)).alias("n_models"),
        F.max_by("version", F.struct("trained_at", "version")).alias("latest"),
        (F.count(F.lit(1)) == 0).alias("fallback_mode"),
    )


def train(spark, base, readings, key, trained_at=None, tag=None, **options):
    """Prepare, fit, measure and save; returns version, forest and metrics.

    ``key`` names columns that identify a reading. Fewer than 100 prepared rows are not trained on: the result is None and the
    models in place stay.
    """
    from_rows = [k for k in dict.fromkeys(("mote_id", *key)) if k not in FEATURES]
    features = prepare_features(readings, tuple(k for k in from_rows if k in readings.columns))
    if features.limit(MIN_ROWS).count() < MIN_ROWS:
        return None
    forest, decided = forests.fit_scored(features, key, **options)
    named = {k: options[k] for k in ("contamination", "n_trees") if k in options}
    metrics = forests.training_metrics(decided, forest, **named).first()
    version = save_model(spark, base, forest, metrics, trained_at, tag)
    return version, forest, metrics


def retrain(spark, base, archive, as_of, key, days=3, tag="scheduled", **options):
    """Train on the archive's last days; only their folders are read."""
    recent = archive.filter(recent_days(as_of, days))
    return train(spark, base, recent, key, as_of, tag, **options)
