"""Session helpers: a tuned local/cluster session and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle partition count is left to the caller / AQE:
# on a cluster it should be sized to the data (≈ input bytes / 128 MB), locally to cores.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # money is summed as decimal; overflow must raise, not wrap
    "spark.sql.ansi.enabled": "true",
    # a chain of merges on (account), (account, note), (account, commitment) keeps one exchange on the account
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # only one period partition is replaced by a publish (K8)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # explicit broadcasts are size-checked by the operators; keep the automatic
    # threshold at Spark's default so AQE can still demote small shuffles
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_spark(master: str | None = None, cpus: int | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName("batchwork")
    if master or cpus:
        b = b.master(master or f"local[{cpus}]")
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
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is used as is.
    Only when it is unset (tests, a laptop) is a private folder created.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="batchwork-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/batchwork-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests and fixtures."""
    return path[5:] if path.startswith("file:") else path


def write_local_text(path: str, lines: list[str] | None = None, data: bytes | None = None) -> str:
    """Write a small fixture file (tests only)."""
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as fh:
        fh.write(data if data is not None else ("\n".join(lines or []) + "\n").encode())
    return path
