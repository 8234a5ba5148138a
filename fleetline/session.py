"""Spark session helpers.

The engine needs three SQL settings regardless of who built the session:
UTC as the session time zone (all timestamps are UTC instants), last-wins
duplicate JSON keys (as a Python ``dict`` decode does) and AQE.  They are
runtime settings, so :func:`prepare_session` can apply them to a session
created elsewhere (for example by a cluster launcher).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fleetline") -> SparkSession:
    """Build (or reuse) a session for tests, the bench and local runs.

    On a cluster the launcher owns the session; call :func:`prepare_session`
    on it instead.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLEETLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and job scratch tables.

    Uses the cluster's ``spark.checkpoint.dir`` when set.  Only when it is
    unset (local tests) a private folder under the system temp dir is made
    and registered, so a cluster run never writes to a machine-local path.
    """
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="fleetline-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local
