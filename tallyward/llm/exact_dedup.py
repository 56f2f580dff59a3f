"""Operator 4: exact duplicates with a heavy-hitter split.

Each partition keeps a Misra-Gries summary of its digests; summed and cut to ``counters`` entries
they hold every digest with more than rows / (counters + 1) rows. A second pass counts exactly
these candidates, so at most ``counters`` verified winners are broadcast and all their rows are
settled where they are. No remaining digest is frequent, so the rest is grouped by an ordinary
shuffle (aggregated before it) and joined back.

Contract: null text counts as empty. Equal means identical after lower-casing A-Z, told by
SHA-256. Rows without doc_id count in group_size; where no row of a group has an id, keep_id is
null and all of them are marked as kept. Rows that repeat a doc_id with equal texts are one
document written twice: both are marked as kept, and kept_documents() returns one of them. Empty
table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import ascii_lower, free_name, stored

COUNTERS = 1024


class MisraGries:
    """At most ``counters`` counters; each is short of its true count by rows / (counters + 1) at
    most."""

    def __init__(self, counters: int):
        self.counters = counters
        self.held = pd.Series(dtype=np.int64)

    def add(self, counts: pd.Series) -> None:
        total = self.held.add(counts, fill_value=0).astype(np.int64)
        if len(total) > self.counters:
            cut = np.partition(total.to_numpy(), -self.counters - 1)[-self.counters - 1]
            total = total - cut
            total = total[total > 0]
        self.held = total


def summaries(digests: DataFrame, counters: int) -> DataFrame:
    """digest and estimate of each partition's summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(counters)
        for batch in batches:
            found = batch.column(0).value_counts()
            summary.add(pd.Series(found.field("counts").to_pylist(), found.field("values").to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(summary.held.index), pa.binary()), pa.array(summary.held.tolist(), pa.int64())],
            names=["digest", "estimate"])

    return digests.select("digest").mapInArrow(run, "digest binary, estimate long")


def candidates(digests: DataFrame, counters: int) -> DataFrame:
    """The merged summary: at most ``counters`` digests, all frequent ones among them."""
    merged = summaries(digests, counters).groupBy("digest").agg(F.sum("estimate").alias("estimate"))
    return merged.orderBy(F.desc("estimate"), "digest").limit(counters).select("digest")


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    digests = stored(docs.select(
        F.col("doc_id"), F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)).alias("digest")), "digests")
    group = (F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = digests.join(F.broadcast(candidates(digests, counters)), "digest")
    winners = F.broadcast(stored(found.groupBy("digest").agg(*group), "winners"))
    heavy = digests.join(winners, "digest")
    rest = digests.join(winners, "digest", "left_anti")
    light = rest.join(rest.groupBy("digest").agg(*group), "digest")
    return heavy.unionByName(light).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def kept_documents(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text."""
    key = free_name(docs, "kept_key")
    stays = exact_groups(docs, counters).filter("kept").select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_sha256").alias(key)).distinct()
    own = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)
    named = docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), own))
    return named.join(stays, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
