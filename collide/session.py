"""Session construction and the shared working folder.

On a cluster the working folder is the one named by ``spark.checkpoint.dir``
(a shared file system path).  Only when that is unset -- local runs and
tests -- do we create a scratch folder and register it ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Bounded broadcast: only sides Spark has measured below 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "collide",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    master = master or os.environ.get("COLLIDE_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("COLLIDE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Path inside the cluster's shared folder (``spark.checkpoint.dir``).

    The setting is read from the session; a scratch folder is created and
    registered only where it is unset (local runs and tests).
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = tempfile.mkdtemp(prefix="collide-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    if not parts:
        return base
    return base.rstrip("/") + "/" + "/".join(parts)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one sink run."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
