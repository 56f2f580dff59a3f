"""Change events: JSON text in, typed good rows and a quarantine out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.parsing import is_blank
from tallyward.schemas import CDC_SCHEMA

_CORRUPT = "_corrupt_record"
KEPT_OPERATIONS = ("c", "u")


def read_cdc(spark: SparkSession, fmt: str = "kafka", options: dict | None = None) -> DataFrame:
    """Streaming ``value`` text column from a broker topic or a folder of JSON lines.

    For a broker pass ``startingOffsets`` (earliest or latest) and ``maxOffsetsPerTrigger``.
    """
    options = dict(options or {})
    path = options.pop("path", None)
    if fmt == "kafka":
        stream = spark.readStream.format("kafka").options(**options).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format("text").options(**options).load(path)


def parse_cdc(df: DataFrame, schema: T.StructType = CDC_SCHEMA, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Split into parsed rows, with the columns ``carry`` of ``df``, and rows that are not valid JSON objects.

    ``inline`` makes each field a real column, so a message is parsed once and not once per
    field that a later step reads.
    """
    wide = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    message = F.from_json(
        "value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = df.select("value", *carry, F.inline(F.array(message)))
    bad = is_blank("value") | F.col(_CORRUPT).isNotNull()
    return parsed.filter(~bad).select(*schema.names, *carry), parsed.filter(bad).select("value")


def filter_ops(df: DataFrame) -> DataFrame:
    """Creates, updates and unmarked rows; deletes and snapshot reads go."""
    op = F.col("__op")
    return df.filter(op.isNull() | op.isin(*KEPT_OPERATIONS))


def count_ops(df: DataFrame) -> DataFrame:
    """Rows per operation and whether the stream keeps them."""
    op = F.coalesce("__op", F.lit("none"))
    return df.groupBy(op.alias("op")).agg(F.count("*").alias("n_rows")).withColumn(
        "is_kept", F.col("op").isin("none", *KEPT_OPERATIONS)
    )
