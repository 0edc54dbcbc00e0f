"""SparkSession construction and shared-folder helpers.

Settings that matter at scale are set here once: UTC session zone (all date/hour parts are
derived in it), AQE with partition coalescing and skew-join splitting, the RocksDB state store
for streaming, and a bounded auto-broadcast threshold (Spark checks the size of a join side at
runtime and keeps a sort-merge join above it).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark itself compares the (runtime) size of a join side with this bound before broadcasting.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # state commits write a changelog instead of uploading a full RocksDB snapshot every batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Large inputs (the 100 TB target): let AQE coalesce shuffles to ~256 MB partitions; split skewed join
# partitions above 1 GB; read ~512 MB of parquet per scan task. The number of shuffle partitions, which AQE
# can only lower, follows the input: ``size_shuffles``.
SHUFFLE_BYTES = 256 * 1024 * 1024
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
}
# Streaming jobs: the shuffle count is the number of state stores per stateful operator, each committed in
# every micro-batch, and is fixed for the life of a checkpoint.
STREAM_CONF = {
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
PROFILES = {"local": {}, "cluster": CLUSTER_CONF, "stream": {**CLUSTER_CONF, **STREAM_CONF}}


def size_shuffles(spark: SparkSession, *paths: str, least: int = 200) -> int:
    """Set the shuffle count for a batch over ``paths`` (about 256 MB of input each), and return it.

    Shuffled rows of the queries here are at most about as large as their input.
    """
    total = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    count = max(least, -(-total // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "martpulse", extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Return the active session, or build one with ``DEFAULT_CONF`` and the profile's settings
    (``cluster``: batch on a cluster, ``stream``: streaming jobs there).

    On a cluster the master comes from ``spark-submit``; ``master`` is only for local runs/tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update(PROFILES[profile])
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared filesystem / object store path); executors may be
    lost at any time, so lineage is cut and streaming state kept only there. Only a local-mode
    session without the setting (tests) gets a fresh scratch folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="martpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for streaming checkpoints and sinks)."""
    return "/".join([checkpoint_root(spark), *parts])
