"""Session construction and the shared scratch location.

On a cluster the deployment names a shared, reliable folder in
``spark.checkpoint.dir``; every intermediate table this package writes
(checkpoints, round-trip sinks) lives below it.  Only a local session with
no such setting gets a private folder, which is what tests use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a JSON leaf that fails to convert (e.g. an object where a struct is
    # declared) nulls that leaf only, not the whole record
    "spark.sql.json.enablePartialResults": "true",
}


# Settings for the target deployment (~100 TB of logs, ~1000 executors).
# Shuffle partitions start high and AQE coalesces them to the advisory size,
# so no stage needs a hand-tuned count; skewed join partitions are split;
# text splits of 256 MiB keep a JSON-parse task to a few seconds; the
# external shuffle service and decommissioning keep shuffle files when an
# executor is lost, so a lost executor costs its running tasks only.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def cluster_builder(app: str) -> SparkSession.Builder:
    """A builder with ``CLUSTER_CONF`` as defaults: whatever spark-submit or
    the deployment has set stays as it is."""
    given = SparkConf()
    b = SparkSession.builder.appName(app)
    for k, v in CLUSTER_CONF.items():
        if not given.contains(k):
            b = b.config(k, v)
    return b


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "driftwood", extra: dict | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF`` (local by default; tests and bench)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, creating a private one
    only for a local session where none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir must name a shared folder on a cluster")
            d = tempfile.mkdtemp(prefix="driftwood-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the checkpoint folder."""
    root = scratch_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
