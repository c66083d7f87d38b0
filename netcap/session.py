"""Session construction and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every netcap job relies on. Session zone UTC: ingestion times
# are UTC wall-clock values (TIMESTAMP_NTZ) and Kafka timestamps are cast
# to that once. AQE re-plans joins and coalesces shuffle partitions at
# runtime and splits skewed partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "netcap", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with netcap's settings.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` so one partition of the position state fits an
    executor core (about 128-256 MB), e.g. 2000-8000 at 100 TB of events.
    A streaming aggregation fixes this number at its first start.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a local one only if it is unset.

    On a cluster the operator sets ``spark.checkpoint.dir`` to a shared
    folder (HDFS, S3, ...); it is never replaced here, and a cluster session
    without it is refused: its executors couldn't see the driver's disk. A
    local session (tests) without it gets a folder under the system temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="netcap-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one job.

    Streaming checkpoints, state deltas, logs and snapshots written by the
    registered queries go here, so they survive executor loss on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/netcap/{name}-{uuid.uuid4().hex[:12]}"
