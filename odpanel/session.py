"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library should carry. AQE re-plans joins from
# runtime sizes (broadcast only when the materialized side is small), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a sort-merge join becomes a hash join at run time only if every build
    # partition fits this bound
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # checkpointed cubes are removed from shared storage once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "odpanel", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces the excess); in tests pass ``local[*]`` and a small
    partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the session's own setting when present
    (``spark.checkpoint.dir`` or an already set SparkContext dir). Only when
    unset on a local master, as in tests, a fresh temporary folder; unset on
    a cluster is an error."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server reads the conf itself
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return conf_dir
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    if not conf_dir and sc.master.split("[")[0] != "local":
        # never a machine-local folder on a cluster: executors could not read it
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = conf_dir or tempfile.mkdtemp(prefix="odpanel-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or the SparkContext's
    checkpoint dir) is used when set. Only when neither is set, as in local
    tests, a temporary folder is created and registered as checkpoint dir.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
