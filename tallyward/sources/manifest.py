"""Partitioned Parquet tables whose versions are committed as a whole.

``data/_commit=<id>/<partition>=<value>`` holds what one write made of one partition. A version is
a small JSON file ``_log/<number>`` that names the folders it consists of and the schema. It gets its
name by a rename that fails if the name is taken: readers see the old version or the new one,
whatever happens in between, and of two writers that start from the same version one is refused.

A merge knows versions of rows: an update that is older than the stored row changes nothing. Updates
are computed once and judged by key and version columns alone, and only the partitions of winning rows
are written again. Whole rows, stored ones and updates, are shuffled once, by their place: a share of a
partition, so that the tasks that join them write them as well. Meanwhile their MD5 keys are 16 bytes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.keys import packed_key, unpacked_key

COMMIT = "_commit"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
PLACE_ROWS = 200_000
CODEC = {"compression": "zstd"}
BY_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
Version = tuple[tuple[str, str], ...]


class Conflict(RuntimeError):
    """Another writer committed a version in the meantime."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its number, schema, partition column and (partition value, commit) folders."""

    number: int
    schema: T.StructType
    partition: str
    folders: tuple[tuple[str, str], ...]

    def only(self, values: set[str]) -> Snapshot:
        return Snapshot(self.number, self.schema, self.partition, tuple(f for f in self.folders if f[0] in values))


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest version; None where there is no table."""
    numbers = [int(n) for n in _names(spark, f"{path}/_log") if n.isdigit()]
    return _version(spark, path, max(numbers)) if numbers else None


def _version(spark: SparkSession, path: str, number: int) -> Snapshot:
    fs, hpath = _fs(spark, f"{path}/_log/{number:012}")
    stream = fs.open(hpath)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(number, T.StructType.fromJson(told["schema"]), told["partition"], tuple(map(tuple, told["folders"])))


def _commit(spark: SparkSession, path: str, version: Snapshot) -> None:
    told = json.dumps({"schema": json.loads(version.schema.json()), "partition": version.partition,
                       "folders": sorted(version.folders)})
    fs, trial = _fs(spark, f"{path}/_log/.trial-{uuid.uuid4().hex}")
    out = fs.create(trial, True)
    out.write(bytearray(told, "utf-8"))
    out.close()
    _, final = _fs(spark, f"{path}/_log/{version.number:012}")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(trial), fs.makeQualified(final), options)
    except Exception as problem:
        if fs.exists(final):
            raise Conflict(f"version {version.number} of {path} was written by another job") from problem
        raise


def _read(spark: SparkSession, path: str, version: Snapshot) -> DataFrame:
    if not version.folders:
        return spark.createDataFrame([], version.schema)
    paths = [f"{path}/data/{COMMIT}={commit}/{version.partition}={value}" for value, commit in version.folders]
    rows = spark.read.schema(version.schema).option("basePath", f"{path}/data").parquet(*paths)
    return rows.select(*version.schema.names)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version. Later commits do not change what this frame reads."""
    found = snapshot(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return _read(spark, path, found)


def _write(df: DataFrame, path: str, partition: str) -> tuple[str, list[str]]:
    """Writes a commit's data; its id and the partition values that got rows."""
    commit = uuid.uuid4().hex
    folder = f"{path}/data/{COMMIT}={commit}"
    df.write.options(**CODEC).partitionBy(partition).parquet(folder)
    prefix = f"{partition}="
    return commit, [n.removeprefix(prefix) for n in _names(df.sparkSession, folder) if n.startswith(prefix)]


def _gathered(df: DataFrame, partition: str) -> DataFrame:
    """The rows of a partition together, in a few tasks if there are many."""
    keys = _hash_keys(df.schema, partition)
    return _unpacked(_packed(df, keys).hint("rebalance", F.col(partition)), df.schema, keys)


def _hash_keys(schema: T.StructType, *but: str) -> list[str]:
    """Text columns that are shuffled as bytes; not those that rows are found by."""
    return [f.name for f in schema if f.name.endswith("_key") and isinstance(f.dataType, T.StringType) and f.name not in but]


def _packed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({c: packed_key(c) for c in keys})


def _unpacked(df: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """Rows of ``schema`` out of packed ones."""
    return df.select(*[unpacked_key(c).alias(c) if c in keys else F.col(c) for c in schema.names])


def rebuild_table(df: DataFrame, path: str, partition: str) -> None:
    """A version that consists of ``df`` alone. ``df`` may read the version before."""
    spark = df.sparkSession
    old = snapshot(spark, path)
    commit, values = _write(_gathered(df, partition), path, partition)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    _commit(spark, path, Snapshot(old.number + 1 if old else 0, schema, partition, tuple((v, commit) for v in values)))


def append_table(df: DataFrame, path: str, partition: str) -> None:
    """The version before and the rows of ``df``."""
    spark = df.sparkSession
    old = snapshot(spark, path)
    if old is None:
        rebuild_table(df, path, partition)
        return
    commit, values = _write(_gathered(df.select(*old.schema.names), partition), path, partition)
    added = tuple((v, commit) for v in values)
    _commit(spark, path, Snapshot(old.number + 1, old.schema, partition, old.folders + added))


def compact_table(spark: SparkSession, path: str, most: int = 8) -> int:
    """Writes partitions of more than ``most`` folders anew, one folder each; how many there were."""
    old = snapshot(spark, path)
    count: dict[str, int] = {}
    for value, _ in old.folders:
        count[value] = count.get(value, 0) + 1
    many = {v for v, n in count.items() if n > most}
    if many:
        commit, values = _write(_gathered(_read(spark, path, old.only(many)), old.partition), path, old.partition)
        kept = tuple(f for f in old.folders if f[0] not in many)
        _commit(spark, path, Snapshot(old.number + 1, old.schema, old.partition, kept + tuple((v, commit) for v in values)))
    return len(many)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drops data that none of the last ``keep`` versions names. No merge may run meanwhile."""
    numbers = sorted(int(n) for n in _names(spark, f"{path}/_log") if n.isdigit())
    named = {commit for n in numbers[-keep:] for _, commit in _version(spark, path, n).folders}
    for name in _names(spark, f"{path}/data"):
        if name.removeprefix(f"{COMMIT}=") not in named:
            _delete(spark, f"{path}/data/{name}")
    for n in numbers[:-keep]:
        _delete(spark, f"{path}/_log/{n:012}")
    _delete(spark, f"{path}/_staged")


def not_older(version: Version) -> Column:
    """Whether an update may replace the stored row (columns ``_old_...``). The columns of ``version``
    are compared one after the other, each ``asc`` (less is better) or ``desc``; no value is worse than
    any; an update of the same version replaces."""
    better = F.lit(True)
    for column, order in reversed(version):
        new, old = F.col(column), F.col(f"_old_{column}")
        wins = new < old if order == "asc" else new > old
        better = F.when(new.eqNullSafe(old), better).otherwise(F.coalesce(wins, new.isNotNull()))
    return better


def _folder(value) -> str:
    return NULL_FOLDER if value is None else str(value)


@contextmanager
def _joined_where_they_are(spark: SparkSession) -> Iterator[None]:
    """Joins may use a shuffle by some of their keys; by default Spark adds one by all of them."""
    before = spark.conf.get(BY_ALL_KEYS)
    spark.conf.set(BY_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(BY_ALL_KEYS, before)


def merge_table(updates: DataFrame, path: str, key: str, partition: str, keep: tuple[str, ...] = (),
                version: Version = ()) -> None:
    """Merge ``updates`` (one row a key) into the table.

    An update that is older than the stored row by ``version`` is dropped. One that wins takes the
    stored value of the ``keep`` columns where it has none. Repeating a merge changes nothing.
    """
    spark = updates.sparkSession
    old = snapshot(spark, path)
    if old is None:
        rebuild_table(updates, path, partition)
        return
    staging = f"{path}/_staged/{uuid.uuid4().hex}"
    numbered = updates.select(*old.schema.names, F.monotonically_increasing_id().alias("_row"))
    numbered.write.options(**CODEC).parquet(f"{staging}/updates")
    fresh = spark.read.schema(numbered.schema).parquet(f"{staging}/updates")
    versions = [c for c, _ in version]
    held = _read(spark, path, old).select(
        key, F.col(partition).alias("_old_partition"), F.lit(True).alias("_stored"),
        *[F.col(c).alias(f"_old_{c}") for c in dict.fromkeys([*versions, *keep])])
    judged = fresh.select(*dict.fromkeys([key, partition, *versions]), "_row").join(held, key, "left").filter(
        F.col("_stored").isNull() | not_older(version))
    judged.select(key, partition, "_row", "_old_partition", "_stored", *[f"_old_{c}" for c in keep]).write.options(
        **CODEC).parquet(f"{staging}/winners")
    winners = spark.read.parquet(f"{staging}/winners")
    beaten = winners.filter("_stored").select(key, F.col("_old_partition").alias(partition))
    # Partition values, not rows: as many as the table has days.
    places = winners.select(partition).union(beaten.select(partition)).distinct()
    touched = {_folder(r[0]) for r in places.collect()}
    if touched:
        stored = _read(spark, path, old.only(touched))
        counts = stored.select(partition).union(winners.select(partition)).groupBy(partition).count()
        hashes = _hash_keys(old.schema, key, partition, *keep)
        shares = -(-counts.agg(F.max("count")).first()[0] // PLACE_ROWS)

        def placed(df: DataFrame, by: str) -> DataFrame:
            place = F.xxhash64(partition, F.pmod(F.xxhash64(by), F.lit(shares)))
            return df.withColumn("_place", place).repartition("_place")

        # No left_anti: Spark moves that in front of the shuffle.
        gone = placed(beaten, key).select("_place", key, F.lit(True).alias("_gone"))
        kept = placed(_packed(stored, hashes), key).join(gone, ["_place", key], "left").filter("_gone is null")
        won = placed(winners, "_row").select("_place", "_row", *[f"_old_{c}" for c in keep])
        new = placed(_packed(fresh, hashes), "_row").join(won, ["_place", "_row"]).withColumns(
            {c: F.coalesce(c, f"_old_{c}") for c in keep})
        rows = _unpacked(kept, old.schema, hashes).unionByName(_unpacked(new, old.schema, hashes))
        with _joined_where_they_are(spark):
            commit, values = _write(rows, path, partition)
        rest = tuple(f for f in old.folders if f[0] not in touched)
        _commit(spark, path, Snapshot(old.number + 1, old.schema, partition, rest + tuple((v, commit) for v in values)))
    try:
        _delete(spark, staging)
    except PySparkException:  # left for vacuum()
        pass


def build(df: DataFrame, path: str, key: str, partition: str, full_refresh: bool,
          keep: tuple[str, ...] = (), version: Version = ()) -> None:
    """Rebuild the table or merge into it."""
    if full_refresh:
        rebuild_table(df, path, partition)
    else:
        merge_table(df, path, key, partition, keep, version)
