"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings: text is parsed in UTC; AQE re-plans joins from measured sizes (a
# side is broadcast only when its real size is under the threshold) and splits hot keys,
# also where that costs one more shuffle for the window behind the join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wide rows take some twenty times their compressed size in a sort, so tasks are cut at 16 MB and
    # hot keys of joins at 32 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Wide projections make methods the JVM refuses to compile; above this size Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyward")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. A local session without one gets a temporary folder; on a
    cluster that would be a different disk for every executor, so one must be named there."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyward-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Materialise ``df`` in the checkpoint folder, so a lost executor never replays its history."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
