"""Session defaults and the shared work folder.

All durable scratch output (checkpoints, staged batches, tables written by the
demo queries) goes under the folder the cluster names in ``spark.checkpoint.dir``.
A machine-local temporary folder is only created when that setting is absent,
which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a load job wants on any cluster: AQE re-plans joins and coalesces
# shuffle partitions at runtime, splits skewed join partitions, and the
# broadcast threshold keeps Catalyst's size check in charge of broadcasting.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "mapflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``); only when it is unset, and Spark
    runs in one local process, is a local folder created and installed instead.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share: a machine's own folder "
                           "cannot hold tables and checkpoints on a cluster")
    local = tempfile.mkdtemp(prefix="mapflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/mapflow/{purpose}-{uuid.uuid4().hex[:12]}"
