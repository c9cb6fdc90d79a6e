"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the checks rely on. `conf` entries win over the defaults.

    Only the time zone and adaptive execution are pinned. Shuffle partitions, memory and split
    size belong to the cluster and are left to its own configuration.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder that `spark.checkpoint.dir` names.

    Where the cluster names none, a session may name one with `setCheckpointDir`.

    All paths of a session lie in one folder of that session, which `drop_staged` removes.
    """
    return f"{_staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def _staging_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir (or setCheckpointDir) must name a folder that all executors share")
    return f"{base.rstrip('/')}/plumbline/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> bool:
    """Remove everything that this application has staged. What reads a staged copy cannot be used afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_staging_root(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
