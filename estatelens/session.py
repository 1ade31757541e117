"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "estatelens",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the settings the library relies on.

    On a cluster the master, memory and checkpoint folder come from the
    launcher; locally (tests, bench) we fill in safe defaults.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    On a cluster the launcher names a shared folder; only local runs (tests,
    bench) fall back to a fresh scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    if not conf_dir:
        # local runs only (tests, bench): a cluster names a shared folder
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="estatelens-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # static in some deployments; the context dir suffices
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables under the shared dir."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
