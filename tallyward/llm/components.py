"""Connected components of a table of links.

Links that fit a task (counted first, LOCAL at most) are joined by union-find in one. More of them
go through alternating star contraction: each round links every node to the smallest neighbour it
has (large star: the larger neighbours, small star: the smaller ones). Links are aggregated before
each shuffle; no neighbour list is collected; rounds grow with the logarithm of the longest path.
Both ways give the same components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import stored

LOCAL = 500_000


def _stars(links: DataFrame) -> DataFrame:
    """(u, v) with u > v after one large and one small star."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["id", "component"])


def connected(links: DataFrame, a: str = "a", b: str = "b", local: int = LOCAL) -> DataFrame:
    """id and component (the smallest id reachable) of every id in a link."""
    now = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v"), "links")
    if now.count() <= local:
        return stored(now.coalesce(1).mapInArrow(_united, "id long, component long"), "components")
    state = None
    while (after := _sum(now)) != state:
        state, now = after, stored(_stars(now), "links")
    own = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return own.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _sum(links: DataFrame):
    """Number of links and checksums of them: equal when nothing moved."""
    return links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(38, 0)))")).first()
