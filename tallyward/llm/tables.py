"""What the operators share: reading tables, written intermediate tables, the workers' import path."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package; keep text comparisons in UTC."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", REPOSITORY)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Texts may be long: small batches bound what a Python worker holds at once.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees. It is named by spark.checkpoint.dir; a local session may do
    without, any other must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps neither recompute it nor
    depend on the executors that made it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """What a Python worker keeps between tasks for one operator. Workers are used again, so whatever
    another operator has left in this one is dropped first."""
    for other, held in _HELD.items():
        if other != name:
            held.clear()
    return _HELD.setdefault(name, {})


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it, as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``limit`` characters together; at least one text each."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def ascii_lower(text):
    """Lower-case A-Z only. Spark's lower() is the quick way where all characters are ASCII."""
    text = F.coalesce(text, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, lower))
