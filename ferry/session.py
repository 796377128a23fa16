"""Session helpers: building a session for tests/bench and finding shared scratch space.

On a cluster the session is built by the platform; the library only *reads*
``spark.checkpoint.dir`` (a shared, fault-tolerant folder) and places every
intermediate it writes below it. A local folder is created only when the
setting is absent, which is the test / laptop case.
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
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ferry", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (UI off, AQE on, UTC)."""
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("FERRY_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set on the cluster; only when it is unset (tests) a fresh local folder is
    made and registered, so ``DataFrame.checkpoint()`` works everywhere.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir appends a per-application UUID folder; use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="ferry-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ferry-{label}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str = "stage"):
    """Cut lineage by writing a Parquet table under the shared checkpoint folder.

    One job computes the frame once; the read-back is columnar, survives
    executor loss, and carries real size statistics for join planning.
    Partition layout is not kept: callers carry what they need as columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)

