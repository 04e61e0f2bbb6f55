"""Session helpers.

The library never assumes a machine-local folder on a cluster: lineage is cut
with ``checkpoint()`` and tables are written under the shared folder named by
``spark.checkpoint.dir``.  Only when that setting is absent (local runs and
tests) does :func:`shared_root` create a temporary folder.
"""

from __future__ import annotations

import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # Broadcast only behind a proven size: no static broadcast from file-size
    # estimates (compressed Parquet can grow many times in memory); explicit
    # hints follow a row count, and AQE converts a join at runtime from the
    # measured shuffle size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects.

    Master, shuffle partitions and memory are the cluster's (``spark-submit``,
    ``spark-defaults.conf``) unless given here; where nothing names a master,
    Spark's own default, a local one, holds.
    """
    builder = SparkSession.builder.appName(app)
    if master or not SparkConf().contains("spark.master"):
        builder = builder.master(master or "local[*]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Sets a
    temporary local one only when the cluster names none, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")
