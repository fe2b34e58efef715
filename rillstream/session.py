"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def build_session(app_name: str = "rillstream", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Start a session with the library's defaults; ``conf`` wins over them.

    Shuffle parallelism is left to the cluster's own settings.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only in a local session without the setting (tests on one machine) a fresh local
    folder is taken, once per session; on a cluster the setting must be there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rillstream-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
