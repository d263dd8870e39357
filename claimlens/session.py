"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "claimlens") -> SparkSession:
    """A local-mode session tuned like a small cluster (tests and bench only)."""
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Root of the shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is read from
    the session. Only when it is unset and the master is local (tests) a
    temporary folder is created and registered as the checkpoint dir; on a
    cluster an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session exposes only the conf
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return root.rstrip("/")
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="claimlens-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    return f"{scratch_dir(spark)}/claimlens/{name}-{uuid.uuid4().hex[:12]}"
