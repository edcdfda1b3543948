"""Session, shared folders and table loading.

Everything here is configuration a Spark user would write by hand: a
session with AQE on, a checkpoint folder taken from the cluster's
``spark.checkpoint.dir``, and scratch folders created under that shared
folder (never under a machine-local temp directory on a cluster).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables the driver generates (TESTDATA.md). Fixed names.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Session settings every entry point shares. AQE re-plans joins at run time
# (broadcast when the measured side is small, split skewed partitions) and
# coalesces small shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Delete reliable checkpoint files (closure rounds, ordinal ranges) once
    # nothing refers to them any more, so the shared folder does not grow.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quartermaster", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the shared settings.

    ``master`` is only for local runs; on a cluster leave it ``None`` and let
    ``spark-submit`` decide. ``shuffle_partitions`` should be sized so one
    shuffle partition is ~128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where unset.

    On a cluster the folder must be named by ``spark.checkpoint.dir``
    (a shared file system every executor can reach). Only a local session
    without that setting gets a private folder, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="qm-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one generated table. Parquet gives column pruning and pushdown."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

