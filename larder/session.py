"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# all are runtime SQL settings; partition counts are left to the cluster and to AQE
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_own_folders: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that is already running."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "larder", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate results.

    Taken from `spark.checkpoint.dir`; only where that is unset (tests on one machine) a temporary
    folder is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.applicationId in _own_folders:
        return _own_folders[spark.sparkContext.applicationId]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="larder-")
    _own_folders[spark.sparkContext.applicationId] = folder
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` by writing it to the shared folder and reading it back.

    The written table survives lost executors and keeps column pruning for what follows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
