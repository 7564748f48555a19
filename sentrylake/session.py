"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on, or that let plans adapt at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rank limits up to this size are applied in every task before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # Recording the Python call site of every column expression costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "sentrylake", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on (UTC hours and dates) on any session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def size_shuffles(spark: SparkSession, shuffled_bytes: int, bytes_per_task: int = 128 << 20) -> int:
    """Set the number of shuffle partitions so that one task gets about ``bytes_per_task``.

    Partitions that turn out small are merged at run time, so it is better to guess high.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-shuffled_bytes // bytes_per_task))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shuffle_parts(df: DataFrame, bytes_per_task: int) -> int:
    """Tasks for a table by the size that its plan is estimated at, a task for each core at least."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A plan without statistics counts as near the largest number there is.
    wanted = -(-size // bytes_per_task) if size < 1 << 50 else int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, wanted)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without one; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if root:
        if current is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="sentrylake-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables a job writes and reads back."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without going back to the events,
    and later reads take only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
