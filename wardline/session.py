"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Cluster sizing (executors, memory) is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_local_roots: dict[str, str] = {}


def build_session(app: str = "wardline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used only where
    that is unset and the master is local, because executors of a cluster could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="wardline-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, never reused path below the scratch root."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch folder and read it back.

    Used where several branches read the same expensive input: each branch then scans only the
    columns it needs, and a lost executor re-reads files rather than recomputing the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
