"""Which stream files have been merged: an append-only table of file names, partitioned by their day.

Names are compared where the rows are, by joins on ``_metadata.file_path``; the driver gets none. Both
the lake and the ledger are read from a first day on: LAG_DAYS before the newest day merged. A file
in an older folder is found by a full refresh only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.manifest import append_table, compact_table, read_table, snapshot

LAG_DAYS = 31
DAY = "dt"
_SLASHES = ":/{2,}"


def file_name(name: Column) -> Column:
    """Spark writes local names with one slash or three, depending on where."""
    return F.regexp_replace(name, _SLASHES, ":/")


@dataclass
class Pending:
    """The files of a snapshot of the lake that are not merged yet, and their rows."""

    rows: DataFrame
    files: DataFrame

    def is_empty(self) -> bool:
        return not self.files.limit(1).count()


def first_day(rows: DataFrame, ledger: str, lag_days: int = LAG_DAYS) -> date | None:
    """The day from which folders may hold new files; None: all."""
    spark = rows.sparkSession
    if snapshot(spark, ledger) is None:
        return None
    newest = read_table(spark, ledger).agg(F.max(DAY)).first()[0]
    return newest - timedelta(days=lag_days) if newest else None


def pending(rows: DataFrame, ledger: str, lag_days: int = LAG_DAYS) -> Pending:
    """What is new in ``rows``, a frame over the lake's files (its files were listed when it was
    made, so later ones come next time). The list of new files is stored before it is used: what is
    recorded afterwards is what was merged."""
    spark = rows.sparkSession
    since = first_day(rows, ledger, lag_days)
    if since is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(since))
    files = rows.select(file_name(F.col("_metadata.file_path")).alias("file"), F.col(DAY)).distinct()
    if since is not None:
        known = read_table(spark, ledger).filter(F.col(DAY) >= F.lit(since)).select("file")
        files = files.join(known, "file", "left_anti")
    path = f"{ledger}/_pending/{uuid.uuid4().hex}"
    files.write.parquet(path)
    stored = spark.read.schema(files.schema).parquet(path)
    oldest = stored.agg(F.min(DAY)).first()[0]
    fresh = rows.withColumn("_file", file_name(F.col("_metadata.file_path")))
    fresh = fresh.filter(F.col(DAY) >= F.lit(oldest) if oldest else F.lit(False))
    return Pending(fresh.join(stored.select(F.col("file").alias("_file")), "_file", "left_semi").drop("_file"), stored)


def record(found: Pending, ledger: str) -> None:
    """After the merge: its files are known from now on."""
    if not found.is_empty():
        append_table(found.files, ledger, DAY)
        compact_table(found.files.sparkSession, ledger)
