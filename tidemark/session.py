"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query in this package assumes.
_CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "tidemark") -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in _CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings on a session someone else built."""
    for k, v in _CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an existing session
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a local one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; we never
    override it.  Only an unconfigured local session (as in tests) gets a fresh temp
    folder: on a cluster other machines would not see it, so there the setting must be made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def checkpoint(df):
    """Reliable checkpoint into the cluster's checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
