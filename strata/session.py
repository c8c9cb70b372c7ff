"""Session helpers.

Library operators never set session configuration.  The only things here are

* :func:`local_session` — a session for tests and the bench (local mode only);
* :func:`shared_root` / :func:`scratch_path` — where operators that must
  materialise data (checked broadcasts, snapshot tables, stream sinks) write.
  On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
  a private temporary folder is only created when the session runs in local
  mode and the setting is absent (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "strata", driver_memory: str = "16g") -> SparkSession:
    """Session for tests and the local bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder for materialised intermediates.

    Resolution order: the checkpoint directory already set on the context,
    then ``spark.checkpoint.dir`` from the session / Spark conf.  Only when
    neither exists *and* the master is local do we create a private folder
    (test runs); on a cluster a missing setting is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared root (nothing is created)."""
    return f"{shared_root(spark).rstrip('/')}/strata-scratch/{label}-{uuid.uuid4().hex[:12]}"
