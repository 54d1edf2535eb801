"""Session construction and the shared folder used for staged data.

Everything here is plain Spark configuration.  The defaults are written for a
cluster: adaptive execution re-plans joins and shuffles from runtime sizes,
skewed shuffle partitions are split, and small partitions are coalesced, so the
same job runs at sf0.01 on a laptop and at 100 TB on a large cluster; the one
setting to size for the data is the initial shuffle partition count (the bytes
of the largest shuffle over about 256 MB).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings applied to every session built here.  Each one is a public Spark key.
BASE_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only behind a size check.  Before running, Spark knows only
    # estimates (compressed file sizes, which can grow several-fold in
    # memory), so the planning-time bound stays at Spark's conservative
    # 10 MB.  Adaptive execution measures the real size of a side after its
    # shuffle stage and re-plans the join as a broadcast below 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "false",
}


# Opt-in settings for large clusters where executors come and go (spot or
# preemptible nodes): a leaving executor first hands its shuffle and cached
# blocks to others, tasks and stages get more attempts, nodes that keep
# failing are excluded, and adaptive execution aims at larger partitions
# instead of maximal parallelism.
CLUSTER_CONF: dict[str, str] = {
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.excludeOnFailure.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
}

LOCAL_DRIVER_MEMORY = "8g"

_shipped_to: set[str] = set()


def build_session(
    master: str | None = None,
    app_name: str = "tallyloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    hive_metastore_uri: str | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Return a session with the library's defaults.

    ``master`` is left unset when None so that ``spark-submit`` decides it on a
    cluster.  ``shuffle_partitions`` defaults to Spark's own value; on a cluster
    see ``suggested_shuffle_partitions`` and let AQE coalesce the rest.
    ``hive_metastore_uri`` (``thrift://host:port``) makes the session catalog a
    Hive metastore, so ``read_table`` reads its tables.  ``cluster`` adds
    ``CLUSTER_CONF`` (executor loss tolerance, larger adaptive partitions).
    """
    builder = SparkSession.builder.appName(app_name)
    if hive_metastore_uri:
        builder = builder.enableHiveSupport().config("spark.hadoop.hive.metastore.uris", hive_metastore_uri)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # One loopback address for both bind and advertised host; binding
            # only one of them loses task results over 1 MB in local mode.
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
            # In local mode the driver heap is the executors' heap too; the
            # 1 GB default makes aggregations spend their time in GC.
            if "spark.driver.memory" not in (extra_conf or {}):
                builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
            # Few cores and small shuffles: let adaptive execution keep more,
            # smaller partitions so CPU-heavy stages (list building, text
            # splitting) still use every core.  Clusters keep the default.
            builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    for key, value in {**BASE_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a distributed file system path
    every executor can reach); without it a job that stages data fails.  Only
    a local master, whose executors are the driver's own threads, gets a fresh
    folder when it is unset.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="tallyloom-shared-")
    sc.setCheckpointDir(local)
    # getCheckpointDir() now reports a per-application sub folder; keep using it.
    return (sc.getCheckpointDir() or local).rstrip("/")


def staging_path(spark: SparkSession, kind: str) -> str:
    """A new, never reused path under the shared folder for one staged output."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of every executor, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped_to:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tallyloom-code-")), "tallyloom-code.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(out)
    _shipped_to.add(sc.applicationId)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
