"""Session helpers: a configured local session for tests and benches, and the
shared folder used to cut lineage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "casewatch") -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench).

    Its catalog warehouse is a fresh temp folder (local runs only).
    """
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="casewatch-warehouse-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", warehouse)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Session settings for large runs. They are SQL settings that can be changed at
# runtime; `apply_scale_conf` sets only those the cluster has not set already.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_scale_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Set the large-run defaults where the session has no value yet; return what was set."""
    applied = {}
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        if spark.conf.get(k, None) is None or (overrides and k in overrides):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Read from the session. Where it is unset, a local session (a test) gets a
    fresh folder under the system temp dir; on a cluster that folder would be
    another one on every machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="casewatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else fallback


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the checkpoint root for a written table."""
    path = os.path.join(checkpoint_root(spark), "casewatch", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(name, []).append(path)
    return path


def drop_scratch(spark: SparkSession, *names: str) -> None:
    """Delete this process's scratch tables of these names, once nothing reads them."""
    from casewatch.sources.files import delete
    for name in names:
        for path in _SCRATCH.pop(name, []):
            delete(spark, path)


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "")
