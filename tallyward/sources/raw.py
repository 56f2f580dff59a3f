"""Extraction from source tables and loading of RAW Parquet."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.parsing import is_blank
from tallyward.schemas import BATCH_COLUMNS
from tallyward.sources.sinks import stringify, with_etl_metadata, write_raw

Reader = Callable[[str], DataFrame]


def jdbc_reader(spark: SparkSession, url: str, partition_column: str | None = None,
                lower: int = 0, upper: int = 0, partitions: int = 1, **options) -> Reader:
    """Reader over a database; split on a numeric column so no single task reads a table."""
    def read(table: str) -> DataFrame:
        r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
                 .option("upperBound", upper).option("numPartitions", partitions))
        return r.load()
    return read


def parquet_reader(spark: SparkSession, root: str) -> Reader:
    return lambda table: spark.read.parquet(f"{root}/{table}")


def extract(table: str, reader: Reader) -> DataFrame:
    """The declared columns of one source table, as text. Card secrets are never selected."""
    df = reader(table)
    present = {c.lower() for c in df.columns}
    columns = [
        (F.col(c) if c.lower() in present else F.lit(None)).cast("string").alias(c)
        for c in BATCH_COLUMNS[table]
    ]
    return df.select(*columns)


_SUMMARY = "table string, n_rows long, status string, message string"


def extract_all(spark: SparkSession, reader: Reader, root: str, batch_id: str, load_ts: str,
                tables: Iterable[str] | None = None, source: str = "CORE") -> DataFrame:
    """Extract and write the chosen tables; one that fails is recorded as -1, the rest go on.

    The loop is over the dozen tables, not over data.
    """
    done = []
    for table in tables or BATCH_COLUMNS:
        try:
            df = with_etl_metadata(extract(table, reader), batch_id, source, load_ts)
            path = write_raw(stringify(df), root, table, batch_id)
            n = spark.read.parquet(path).count()
            done.append((table, n, "SUCCESS", None))
        except Exception as problem:
            done.append((table, -1, "FAILED", str(problem).split("\n")[0][:300]))
    return spark.createDataFrame(done, _SUMMARY)


def load_raw(spark: SparkSession, path: str, schema: T.StructType,
             on_error: str = "fail") -> DataFrame:
    """RAW Parquet by column name: case does not matter, missing columns are NULL.

    With ``on_error="continue"`` unreadable files are skipped; skipped_files() names them.
    """
    return (
        spark.read.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", str(on_error == "continue").lower())
        .parquet(path)
    )


def skipped_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files below ``path`` that a load with ``on_error="continue"`` takes no row from: unreadable or empty ones."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
              .select(F.col("_metadata.file_path").alias("file")))
    read = load_raw(spark, path, schema, "continue").select(F.col("_metadata.file_path").alias("file")).distinct()
    return listed.join(read, "file", "left_anti")


def load_new_files(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
                   sink: Callable[[DataFrame, int], None], glob: str = "*.parquet") -> None:
    """Run ``sink(new_rows, batch_number)`` over files not seen by this checkpoint yet."""
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").parquet(path)
    )
    query = (
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def load_summary(df: DataFrame, table: str, key: str, unit: str = "_SOURCE_FILE") -> DataFrame:
    """Units (files or loads), rows, rows with a blank key, and a status, for one table."""
    per_unit = df.groupBy(unit).agg(
        F.count("*").alias("n"), F.sum(is_blank(key).cast("int")).alias("bad")
    )
    total = per_unit.agg(
        F.count("*").alias("n_units"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("n_errors"),
    )
    status = (
        F.when((F.col("n_rows") == 0) | (F.col("n_errors") == F.col("n_rows")), "FAILED")
        .when(F.col("n_errors") > 0, "PARTIAL").otherwise("SUCCESS")
    )
    return total.select(F.lit(table).alias("table_name"), "n_units", "n_rows", "n_errors",
                        status.alias("status"))


def load_totals(summaries: DataFrame) -> DataFrame:
    """All tables of a load together: tables, rows, blank keys, and the names of those that failed."""
    failed = F.sort_array(F.collect_list(F.when(F.col("status") == "FAILED", F.col("table_name"))))
    return summaries.agg(
        F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"), F.sum("n_errors").alias("n_errors"),
        F.sum((F.col("status") == "FAILED").cast("int")).alias("n_failed"),
        F.array_join(failed, ",").alias("failed_tables"))


def labels(fact_transaction: DataFrame) -> DataFrame:
    """Labelled transactions as 0/1."""
    return fact_transaction.filter(F.col("is_fraud_confirmed").isNotNull()).select(
        F.trim("transaction_id").alias("transaction_id"),
        F.col("is_fraud_confirmed").cast("int").alias("label"),
    )


def since(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows newer than the newest row of ``target``; all rows while that is empty."""
    newest = F.coalesce(F.max(target_column), F.lit("1970-01-01").cast("timestamp"))
    return df.filter(F.col(column) > target.select(newest).scalar())
