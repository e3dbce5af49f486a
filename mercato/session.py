"""Session helpers: a local session for tests/bench and the shared scratch folder.

The library never builds its own session for real work; callers pass one in.
Scratch output (round trips, materialised tables) goes under the folder the
cluster names in ``spark.checkpoint.dir`` so that every executor can read it
back after a lost task; a machine-local temp folder would not survive that.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "mercato") -> SparkSession:
    """A ``local[cores]`` session with AQE on and the UI off (tests, bench)."""
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster the folder comes from the session (shared storage) and an
    unset value is an error. Only a ``local[...]`` session with nothing
    configured (a test) gets a temp folder.
    """
    sc = _context(spark)
    current = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc is not None else None)
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):  # local-cluster has executors of its own
            raise ValueError(
                f"set {CHECKPOINT_CONF} to a folder on shared storage: scratch tables must be "
                "readable by every executor"
            )
        current = tempfile.mkdtemp(prefix="mercato-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/mercato/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete every scratch table that this library wrote under the checkpoint folder.

    Results that still read one (a DataFrame that was not written or collected
    yet) need them, so this is for the end of a job.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/mercato")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
