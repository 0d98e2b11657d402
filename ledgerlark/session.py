"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ABFS ...).  We only ever *read* that setting; a private folder is
created solely when the session has none, which happens in unit tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on.  AQE re-plans joins from measured shuffle sizes
# (runtime broadcast, partition coalescing, skew splitting), which is what
# keeps a hot order or customer from pinning a single task.
RECOMMENDED_CONF: dict[str, str] = {
    # No broadcast from the planner's *estimate* (compressed file sizes can be
    # 10x below the in-memory size, so a large fact side may qualify).  AQE
    # still broadcasts a side whose *measured* shuffle output is below the
    # adaptive threshold, which is a checked bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a
    # whole-stage method that large would run interpreted (measured 5x slower
    # on the feed parse).  Above this size Spark keeps per-expression codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlark",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def is_one_machine(master: str) -> bool:
    """Whether the driver's own disk is the executors' as well."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster-wide working folder (``spark.checkpoint.dir``).

    The value configured on the session wins.  When nothing is set, a ``local``
    master (tests) gets a private temporary folder; on a cluster it is an error,
    because each executor would write to its own disk.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = context.getCheckpointDir()
    if not configured and not is_one_machine(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="ledgerlark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")
