"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job here relies on.  AQE supplies runtime coalescing, broadcast
# conversion, skew-join splitting and REBALANCE splitting.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # no Python call-site capture per column expression while plans are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}


def local_session(
    cores: int | str = "*",
    app_name: str = "tidemark",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and the bench.  On a cluster, pass your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for staging tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost together with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[application]


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the work folder that no other call gets."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read back.

    For a result that is used more than once: it is computed once, its lineage
    ends in files that outlive an executor, and its size is known to the planner.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder with what is in it, on whatever store it lies; none is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
