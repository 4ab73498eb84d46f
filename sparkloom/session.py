"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the session is created by the platform; nothing here overrides its settings.
``shared_dir`` reads ``spark.checkpoint.dir`` (the shared folder the cluster names) and only
falls back to a private temporary folder when the master is local and nothing is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkloom") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, ANSI on. Local files are written without checksum files: without
    Hadoop's native library each created file, and each checksum file, costs a forked ``chmod``."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a checkout that is not installed)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses the session's ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when none
    is set *and* the master is local (tests, bench) is a private folder created and registered.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the session conf is visible
        sc = None
    if sc is not None:
        if sc.getCheckpointDir():
            return sc.getCheckpointDir().rstrip("/")
        configured = configured or sc.getConf().get(_CHECKPOINT_KEY, None)
        if configured:  # named in the conf only: register it so DataFrame.checkpoint() uses it too
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir().rstrip("/")
    if configured:
        return configured.rstrip("/")
    if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            f"{_CHECKPOINT_KEY} is not set; configure a shared folder (HDFS/S3/...) for this cluster"
        )
    path = tempfile.mkdtemp(prefix="sparkloom-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, never reused. Nothing here deletes it: on a
    cluster give the folder a lifetime rule, and set ``spark.cleaner.referenceTracking.cleanCheckpoints``
    for the folders of ``checkpoint()``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
