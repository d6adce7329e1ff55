"""Session helpers: building a session for tests/bench and locating shared work folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on. Time zone is pinned so that day boundaries,
# epoch conversions and formatted times do not depend on the machine running the driver.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# For sessions built here: streaming state in RocksDB (off-heap, spills to local disk, changelog
# checkpoints), so day-window state can grow past executor heap. Not forced on an existing
# session by ``prepare``: a checkpoint keeps the provider it was created with.
STREAM_STATE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Suggested settings for a large cluster (not applied automatically; pass them to the cluster's
# session builder or to ``build_session(extra=CLUSTER_SETTINGS)``). Partition sizes come from
# AQE's advisory size instead of a fixed count, so each task stays within executor memory.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickflow", extra: dict | None = None) -> SparkSession:
    """A session for local runs (tests, bench). On a cluster, use the cluster's own session
    and call :func:`prepare` on it instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("CLICKFLOW_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in {**SESSION_DEFAULTS, **STREAM_STATE_DEFAULTS}.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators assume (UTC time zone, AQE)."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the durable, shared location the cluster names; a cluster session
    without it raises, since a folder of one machine would lose what other executors write. A
    local session has one machine only, so there a temporary folder is made when none is set.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def written(df, name: str):
    """``df`` written to a fresh folder under the shared root and read back: evaluated once,
    lineage cut, and its true size known to the planner."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one run of one job (tables, stream state)."""
    return f"{shared_root(spark)}/clickflow/{name}-{uuid.uuid4().hex[:12]}"


def workers_import(spark: SparkSession) -> None:
    """Let this session's Python workers import the package from where the driver has it (on a cluster the
    package is installed on the executors)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])
