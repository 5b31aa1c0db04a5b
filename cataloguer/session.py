"""Session helpers: a local session for tests/bench, and the shared checkpoint folder.

On a cluster the session is created by the caller; the library only reads its
settings. ``spark.checkpoint.dir`` must name a shared (distributed) folder there;
a local folder is chosen only when the setting is unset and the master is local.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "cataloguer", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CATALOGUER_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the session's checkpoint folder, choosing a local one only in local mode.

    With a remote (Spark Connect) session the server's own setting applies and
    nothing is set here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        return spark.conf.get(_CHECKPOINT_KEY, None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; set it to a shared folder (HDFS/S3/ABFS) on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cataloguer-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for exports, versions, streams)."""
    base = (ensure_checkpoint_dir(spark) or "").rstrip("/")
    if not base:
        raise RuntimeError("spark.checkpoint.dir is unset; it must name a shared folder")
    return f"{base}/cataloguer-scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder as compressed columns and read back, so its steps run once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
