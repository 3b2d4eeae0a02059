"""Spark session settings the engine relies on.

One setting is semantic, not tuning: ``spark.sql.session.timeZone=UTC``. Timestamps are
zone-less (``timestamp_ntz``); ``date_trunc`` round-trips through the session zone, so pin a zone
without DST gaps. Writers that replace single partitions say so in their own write options.

Everything else (AQE, skew join, coalescing) is the scale profile: shuffle
partition counts are decided at runtime from real map-output sizes, and a skewed
join partition (one hot key holding a large share of rows) is split.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target ~128 MiB per post-shuffle partition; AQE coalesces small ones
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the semantic settings on an existing session (idempotent)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shoplane") -> SparkSession:
    """A local session for tests and the bench (UI off, no server opened)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("SHOPLANE_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         # catalog databases of local runs go to a scratch folder, not the working directory
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shoplane-warehouse-")))
    for k, v in {**SCALE_CONF, **SEMANTIC_CONF}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return apply_conf(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; without it there is no folder
    that the driver and all executors see, so a session with another master than ``local`` is an
    error. Only a local session (tests, the bench) gets a private scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master: {master or 'unknown'})")
        d = tempfile.mkdtemp(prefix="shoplane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def copartitioned_session(spark: SparkSession) -> SparkSession:
    """A session of its own with the caller's settings, in which sides that lie together by one of several join
    keys join without a further exchange. Only where no value of that key is hot."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


_SCRATCH = "shoplane.scratch.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written intermediates."""
    base = (spark.conf.get(_SCRATCH, None) or ensure_checkpoint_dir(spark)).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str):
    """Intermediates written inside the block share one folder, which is deleted at its end.

    For work that ends with written tables; a lazy result must not outlive the block. A block inside
    another one leaves the deletion to the outer one. One block at a time per session.
    """
    if spark.conf.get(_SCRATCH, None):
        yield
        return
    base = scratch_path(spark, name)
    spark.conf.set(_SCRATCH, base)
    try:
        yield
    finally:
        spark.conf.unset(_SCRATCH)
        delete(spark, base)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop file API, for any store that Spark can write to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
