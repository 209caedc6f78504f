"""Session defaults for tests and the bench, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores="8", shuffle_partitions="8", app="sensorlake"):
    """A local session; on a cluster the submitter's own settings apply instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        # little data over many folders: keep several tasks writing
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )


def shared_folder(spark):
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master without that setting gets a fresh temporary folder. A cluster
    without it is an error, because a folder of one machine would lose data.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sensorlake-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark, name):
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df, name="table", rows_per_file=None):
    """The frame as a Parquet table in the shared folder.

    Work that is read more than once is done once, the lineage ends there, and the
    rows outlive a lost executor. A file is read by one task, mostly; where reading it is
    followed by long work per row, ``rows_per_file`` bounds it.
    """
    path = scratch_path(df.sparkSession, name)
    write = df.write if rows_per_file is None else df.write.option("maxRecordsPerFile", rows_per_file)
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
