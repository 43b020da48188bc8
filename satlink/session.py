"""Session helpers: a tuned local session for tests/bench and the shared work folder.

Every write the library makes (snapshots, landing roundtrips, lineage cuts) goes under the
folder the cluster names in ``spark.checkpoint.dir``. We only set our own folder when the
session has none, as in tests on one machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "satlink") -> SparkSession:
    """Session for tests and the local bench: AQE on, UTC, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small local inputs: keep enough post-shuffle tasks busy for CPU-bound JSON work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SATLINK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for everything the library writes.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); when neither is set,
    a local-mode session (tests) gets a fresh folder registered as the checkpoint dir, and
    a cluster session is refused rather than handed a machine-local folder.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is invisible to other executors: refuse on a cluster.
            raise RuntimeError(f"set {_CKPT_KEY} to a shared folder (HDFS, S3, ...) for this cluster")
        root = tempfile.mkdtemp(prefix="satlink-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the work root for one run of ``label``."""
    return f"{work_root(spark)}/satlink/{label}/{uuid.uuid4().hex}"
