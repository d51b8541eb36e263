"""Session construction and shared storage locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app_name: str = "pricedex") -> SparkSession:
    """Session for tests, bench and local runs. On a cluster, submit with the cluster's own settings instead."""
    master = master or os.environ.get("PRICEDEX_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PRICEDEX_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when nothing is configured and the master is local (tests, laptops) a folder under /tmp is
    created; on a cluster an unset value is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="pricedex-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_table_root(spark: SparkSession) -> str:
    """Folder for tables this library materialises (bronze stand-ins), next to the checkpoints."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/pricedex-tables/{application_id(spark)}"
