"""Session helpers: configuration for scale and a shared scratch folder.

Nothing here changes query semantics; the functions only read settings
from the session and fill in defaults where a setting is absent (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we want on a large cluster. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones, so a hot key
# (a third of all rows on one segment or one day) does not land in one task.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """Local session used by tests and the bench (the driver passes its own)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_classic(spark: SparkSession) -> bool:
    """True for a classic (JVM-backed) session, False for Spark Connect."""
    try:
        spark.sparkContext
        return True
    except Exception:
        return False


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach; we
    read it from the session. Only when it is unset (local tests) do we make
    our own folder and register it, so ``DataFrame.checkpoint()`` works.
    """
    if not is_classic(spark):
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:  # the server may be a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            # A driver-local folder is not reachable from the executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "scratch", f"{label}-{uuid.uuid4().hex}")
