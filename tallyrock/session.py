"""Session settings and the shared folder for files between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job relies on; all are ordinary runtime SQL settings.
RUNTIME_SETTINGS = {
    # Text without a zone is read, and CSV is written, as UTC.
    "spark.sql.session.timeZone": "UTC",
    # The default timestamp encoding keeps no min/max, so the incremental
    # filter on ingestion_time could not skip any row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Rows take ten times the room of their Parquet files once they are sorted: a scan task that
    # feeds a sort stays in memory with a quarter of the default.
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# For submitted jobs, unless spark-submit sets them: shuffle output, and with it
# table files, of this size rather than one small file per core.
JOB_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def job_session(name: str) -> SparkSession:
    """The session of a submitted job; master, memory and packages come from spark-submit."""
    spark = configure(SparkSession.builder.appName(name).getOrCreate())
    submitted = dict(spark.sparkContext.getConf().getAll())
    for key, value in JOB_SETTINGS.items():
        if key not in submitted:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="tallyrock-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is reused between calls."""
    return f"{shared_dir(spark)}/tallyrock/{label}-{uuid.uuid4().hex}"
