"""Latest-row-per-key operators.

``row_number() = 1`` lets Spark prune every map task to one row per key before the shuffle
(WindowGroupLimit), so a key that fills a third of the input still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``; whole-row hash breaks ties."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [F.col(c) for c in df.columns]
    tie = F.xxhash64(*payload)
    w = Window.partitionBy(*keys).orderBy(*order, F.col("_tie"))
    return (
        df.withColumn("_tie", tie)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "_tie")
    )


def by_priority(df: DataFrame, key: str, priority: str, load_ts: str) -> DataFrame:
    """Across sources: lowest priority number wins, then the newest row."""
    return latest_per_key(df, key, [F.col(priority).asc(), F.col(load_ts).desc_nulls_last()])
