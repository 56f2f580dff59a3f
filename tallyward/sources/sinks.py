"""Writing: RAW batches, the partitioned lake, rebuilds and published versions of small tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.keys import row_hash

RAW_FILE_ROWS = 1_000_000


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; times and dates in ISO form, NULL stays NULL."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def with_etl_metadata(df: DataFrame, batch_id: str, source: str, load_ts: str) -> DataFrame:
    return df.select(
        "*",
        F.lit(batch_id).alias("_BATCH_ID"),
        F.lit(source).alias("_SOURCE_SYSTEM"),
        F.lit(load_ts).alias("_LOAD_TS"),
        row_hash(df.columns).alias("_ROW_HASH"),
    )


def with_audit(df: DataFrame, now: str) -> DataFrame:
    return df.withColumn("etl_load_timestamp", F.lit(now).cast("timestamp"))


def write_raw(df: DataFrame, root: str, table: str, batch_id: str,
              rows_per_file: int = RAW_FILE_ROWS) -> str:
    """Write one table's batch below ``batch_<id>``; a repeat of the batch replaces it."""
    path = f"{root}/{table}/batch_{batch_id}"
    (df.write.mode("overwrite").option("compression", "snappy")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))
    return path


def write_lake(df: DataFrame, path: str, batch_ts: str, batch_id, run: str = "0") -> str:
    """Write a micro-batch below the folders of its date and hour, run and number.

    Dates are outermost, so a reader lists only the days it wants. A replay that brings the same
    ``batch_ts`` replaces what it wrote; another run (checkpoint) never does.
    """
    target = f"{path}/dt={batch_ts[:10]}/hr={batch_ts[11:13]}/run={run}/mb={batch_id}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return target


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def merge_upsert(target: DataFrame, updates: DataFrame, key, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target rows without a matching update, plus all updates.

    An update takes the stored value of the ``keep`` columns where it has none itself.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    if keep:
        stored = target.select(*keys, *[F.col(c).alias(f"_stored_{c}") for c in keep])
        updates = updates.join(stored, keys, "left").select(*[
            F.coalesce(c, f"_stored_{c}").alias(c) if c in keep else F.col(c) for c in updates.columns])
    return kept.unionByName(updates)


def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of a published table's newest version; ``path`` itself while there is none."""
    for pointer in (f"{path}__current", f"{path}__retired"):  # retired: a switch was cut short
        if _exists(spark, pointer):
            return spark.read.text(pointer).first()[0]
    return path


def publish(df: DataFrame, path: str) -> str:
    """Write a new version beside the old one, then switch the pointer. ``df`` may read the old
    version; a failure at any point leaves one of the two in place. Older versions are dropped
    at the next publication."""
    spark = df.sparkSession
    old = current_path(spark, path)
    new = f"{path}__versions/{uuid.uuid4().hex}"
    df.write.parquet(new)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    trial = f"{path}__pointer-{uuid.uuid4().hex}"
    spark.createDataFrame([(new,)], "value string").coalesce(1).write.text(trial)
    pointer = fs_path(f"{path}__current")
    retired = fs_path(f"{path}__retired")
    fs.delete(retired, True)
    if fs.exists(pointer):
        fs.rename(pointer, retired)
    fs.rename(fs_path(trial), pointer)
    folder = fs_path(f"{path}__versions")
    for status in fs.listStatus(folder):  # two or three versions
        held = status.getPath().getName()
        if held not in (new.rsplit("/", 1)[1], old.rsplit("/", 1)[1]):
            fs.delete(status.getPath(), True)
    return new


def register_model(registry: DataFrame, row: DataFrame) -> DataFrame:
    """Retire every active model and add the new one as active."""
    retired = registry.withColumn("is_active", F.lit(False))
    return retired.unionByName(row.withColumn("is_active", F.lit(True)), allowMissingColumns=True)
