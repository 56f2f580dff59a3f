"""Versioned tables: merges that know which row is newer, commits as a whole, the ledger of files."""

import os
import shutil
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyward.sources import ledger as L
from tallyward.sources import manifest as M

FACT = "id string, day int, amount int, label boolean, prio int, at timestamp"
VERSION = (("prio", "asc"), ("at", "desc"))


def at(hour):
    return datetime(2024, 1, 1, hour)


def fact(spark, *rows):
    return spark.createDataFrame(rows, FACT)


def merge(updates, path):
    M.merge_table(updates, path, "id", "day", ("label",), VERSION)


def told(spark, path):
    return {r["id"]: (r["day"], r["amount"], r["label"]) for r in M.read_table(spark, path).collect()}


def test_an_older_version_never_wins(spark, tmp_path):
    path = str(tmp_path / "fact")
    merge(fact(spark, ("a", 1, 1, None, 2, at(8)), ("b", 1, 1, True, 1, at(8)), ("c", None, 1, None, 2, None)), path)
    merge(fact(spark, ("a", 1, 2, None, 2, at(9))), path)
    merge(fact(spark, ("a", 2, 3, None, 2, at(8))), path)  # older
    assert told(spark, path)["a"] == (1, 2, None)
    merge(fact(spark, ("b", 1, 9, False, 2, at(23))), path)  # newer, but of the weaker source
    assert told(spark, path)["b"] == (1, 1, True)
    merge(fact(spark, ("b", 3, 7, None, 1, at(8)), ("c", 4, 5, None, 2, at(1)), ("d", None, 1, None, 1, None)), path)
    assert told(spark, path) == {"a": (1, 2, None), "b": (3, 7, True), "c": (4, 5, None), "d": (None, 1, None)}
    merge(fact(spark, ("c", 4, 6, None, 2, None)), path)  # no time is older than any
    assert told(spark, path)["c"] == (4, 5, None)


def test_only_partitions_of_winners_are_written(spark, tmp_path):
    path = str(tmp_path / "fact")
    M.rebuild_table(fact(spark, *[(f"k{i}", i % 5, i, None, 1, at(5)) for i in range(50)]), path, "day")
    before = M.snapshot(spark, path)
    merge(fact(spark, ("k0", 0, 100, None, 1, at(4)), ("k1", 2, 100, None, 1, at(6))), path)  # k0 loses, k1 moves from 1 to 2
    after = M.snapshot(spark, path)
    assert {v for v, _ in set(after.folders) - set(before.folders)} == {"1", "2"}
    old = M._read(spark, path, before)  # a reader that began before still sees its version
    assert old.count() == 50 and old.filter("amount = 100").count() == 0
    merge(fact(spark, ("k0", 0, 100, None, 1, at(4))), path)  # nothing wins: no new version
    assert M.snapshot(spark, path).number == after.number
    plan = M.read_table(spark, path).filter("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_merge_cut_short_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    M.rebuild_table(fact(spark, *[(f"k{i}", i % 4, i, None, 1, at(5)) for i in range(40)]), path, "day")
    before = told(spark, path)
    updates = fact(spark, *[(f"k{i}", i % 4, -i, None, 1, at(6)) for i in range(40)])
    write = M._write

    def killed_between_partitions(df, where, partition):
        write(df.filter("day < 2"), where, partition)
        raise KeyboardInterrupt

    monkeypatch.setattr(M, "_write", killed_between_partitions)
    with pytest.raises(KeyboardInterrupt):
        merge(updates, path)
    assert told(spark, path) == before
    monkeypatch.setattr(M, "_write", write)
    monkeypatch.setattr(M, "_commit", lambda *_: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError):
        merge(updates, path)
    monkeypatch.undo()
    assert told(spark, path) == before
    merge(updates, path)
    assert {v[1] for v in told(spark, path).values()} == {-i for i in range(40)}
    M.vacuum(spark, path, keep=1)
    assert len(os.listdir(f"{path}/data")) == 1 and len(told(spark, path)) == 40


def test_of_two_writers_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "fact")
    M.rebuild_table(fact(spark, ("a", 1, 1, None, 1, at(1))), path, "day")
    old = M.snapshot(spark, path)
    merge(fact(spark, ("a", 1, 2, None, 1, at(2))), path)
    with pytest.raises(M.Conflict):
        M._commit(spark, path, M.Snapshot(old.number + 1, old.schema, "day", old.folders))
    assert told(spark, path)["a"] == (1, 2, None)


def test_updates_are_computed_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    M.rebuild_table(fact(spark, ("a", 1, 1, None, 1, at(1))), path, "day")
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    merge(fact(spark, *[(f"u{i}", i % 3, i, None, 1, at(2)) for i in range(30)]).mapInArrow(count, FACT), path)
    assert runs.value == 30 and len(told(spark, path)) == 31


WIDE = "id string, day int, amount int, label boolean, prio int, at timestamp, city_key string"


def keyed(spark, *rows):
    return spark.createDataFrame(rows, WIDE)


def plans_of_writes(monkeypatch, folder):
    """Plans of what is written to paths that hold ``folder``, as they come."""
    from pyspark.sql.readwriter import DataFrameWriter
    parquet, plans = DataFrameWriter.parquet, []

    def seen(self, where, *args, **kwargs):
        if folder in where:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, where, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    return plans


def test_whole_rows_are_shuffled_once_in_a_merge(spark, tmp_path, monkeypatch):
    """No shuffle lies above another one: the tasks that join rows write them, too."""
    path, plans = str(tmp_path / "fact"), plans_of_writes(monkeypatch, "/data/")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(M, "PLACE_ROWS", 4, raising=False)
    rows = [(f"k{i}", i % 3, i, None, 1, at(5), f"{i:032x}") for i in range(40)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        M.rebuild_table(keyed(spark, *rows), path, "day")
        merge(keyed(spark, *[(*r[:2], -r[2], *r[3:]) for r in rows[::2]], ("new", 1, 1, None, 1, at(5), "-1")), path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above, most = [], 0
    for line in plans[-1].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [d for d in above if d < depth]
        if line.lstrip(" :+-").startswith("Exchange"):
            above.append(depth)
            most = max(most, len(above))
    assert most == 1
    found = {r["id"]: (r["amount"], r["city_key"]) for r in M.read_table(spark, path).collect()}
    assert found == {f"k{i}": (-i if i % 2 == 0 else i, f"{i:032x}") for i in range(40)} | {"new": (1, "-1")}


def test_a_merge_reads_whole_updates_only_to_write_them(spark, tmp_path, monkeypatch):
    """Updates are judged by key and version: where none wins, no other column is read again."""
    path, read = str(tmp_path / "fact"), plans_of_writes(monkeypatch, "/winners")
    M.rebuild_table(keyed(spark, ("a", 1, 1, None, 1, at(5), "x")), path, "day")
    merge(keyed(spark, ("a", 1, 9, None, 1, at(4), "y")), path)
    assert len(read) == 1 and "prio" in read[0] and "city_key" not in read[0] and "amount" not in read[0]
    assert M.read_table(spark, path).first()["amount"] == 1


def test_merges_of_null_keys_null_days_and_twins(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "PLACE_ROWS", 2, raising=False)
    path = str(tmp_path / "fact")
    M.rebuild_table(fact(spark, (None, 1, 1, True, 1, at(5)), (None, None, 2, None, 1, at(5)), ("a", None, 3, True, 1, at(5)),
                         ("b", 2, 4, None, 1, at(5))), path, "day")
    merge(fact(spark, (None, 1, 10, None, 1, at(6)), (None, 1, 10, None, 1, at(6)), ("a", None, 11, None, 1, at(6)),
               ("b", None, 12, False, 1, at(6)), ("c", 3, 13, None, 1, at(6)), ("c", 3, 14, None, 1, at(6))), path)
    got = Counter((r["id"], r["day"], r["amount"], r["label"]) for r in M.read_table(spark, path).collect())
    assert got == Counter({(None, 1, 1, True): 1, (None, None, 2, None): 1, (None, 1, 10, None): 2, ("a", None, 11, True): 1,
                           ("b", None, 12, False): 1, ("c", 3, 13, None): 1, ("c", 3, 14, None): 1})


def test_rows_are_found_by_hash_keys_too(spark, tmp_path):
    """Key, partition and kept columns may be MD5 text themselves."""
    path, schema = str(tmp_path / "snap"), "snap_key string, part_key string, label_key string, n_key string, n int"
    h = [f"{i:032x}" for i in range(9)]
    for rows in ([(h[0], h[5], h[6], h[1], 1), (h[1], h[5], None, "-1", 2), (h[2], "-1", h[8], None, 3)],
                 [(h[0], h[5], None, h[2], 4), (h[1], "-1", h[7], h[3], 5), (h[3], h[5], None, h[4], 6)]):
        M.merge_table(spark.createDataFrame(rows, schema), path, "snap_key", "part_key", ("label_key",))
    got = {tuple(r) for r in M.read_table(spark, path).select("snap_key", "part_key", "label_key", "n_key", "n").collect()}
    assert got == {(h[0], h[5], h[6], h[2], 4), (h[1], "-1", h[7], h[3], 5), (h[2], "-1", h[8], None, 3), (h[3], h[5], None, h[4], 6)}


def test_packed_keys_come_back(spark):
    odd = [None, "", "-1", "a" * 15, "a" * 16, "f" * 31, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "g" * 32,
           "a" * 32 + "\n", "\u00e9" * 8, "\u00e9" * 16, "\0" * 16, "a" * 33, "a" * 64]
    df = spark.createDataFrame([(i, k, k) for i, k in enumerate(odd)], "i int, x_key string, other string")
    packed = M._packed(df, M._hash_keys(df.schema))
    assert dict(packed.dtypes)["x_key"] == "binary" and dict(packed.dtypes)["other"] == "string"
    assert len({bytes(r[0]) for r in packed.select("x_key").collect() if r[0] is not None}) == len(odd) - 1
    assert [r["x_key"] for r in M._unpacked(packed, df.schema, ["x_key"]).orderBy("i").collect()] == odd


def test_append_and_compact(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(4):
        M.append_table(spark.createDataFrame([(f"f{i}", date(2024, 1, 1 + i % 2))], "file string, dt date"), path, "dt")
    assert len(M.snapshot(spark, path).folders) == 4
    assert M.compact_table(spark, path, most=1) == 2 and len(M.snapshot(spark, path).folders) == 2
    assert Counter(r["file"] for r in M.read_table(spark, path).collect()) == Counter(f"f{i}" for i in range(4))


def test_ten_thousand_files(spark, tmp_path, monkeypatch):
    """New files are found by joins; the driver takes no names, and old days are not read."""
    lake, ledger = str(tmp_path / "lake"), str(tmp_path / "ledger")
    spark.range(1).select(F.lit("x").alias("TransactionID")).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = next(f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet"))
    days = [f"2024-{m:02}-{d:02}" for m in (1, 2, 3, 4) for d in range(1, 26)]
    for day in days:
        os.makedirs(f"{lake}/dt={day}")
        for i in range(100):
            shutil.copyfile(tmp_path / "one" / one, f"{lake}/dt={day}/part-{i}.parquet")

    def listed():
        return spark.read.schema("TransactionID string").parquet(lake)

    taken = []
    from pyspark.sql.classic.dataframe import DataFrame
    collect = DataFrame.collect

    def counted(self):
        rows = collect(self)
        taken.append(len(rows))
        return rows

    monkeypatch.setattr(DataFrame, "collect", counted)
    first = L.pending(listed(), ledger)
    assert first.rows.agg(F.count("*").alias("n")).first()[0] == 10_000
    L.record(first, ledger)
    shutil.copyfile(tmp_path / "one" / one, f"{lake}/dt=2024-04-20/late.parquet")
    os.makedirs(f"{lake}/dt=2024-04-26")
    shutil.copyfile(tmp_path / "one" / one, f"{lake}/dt=2024-04-26/new.parquet")
    second = L.pending(listed(), ledger)
    L.record(second, ledger)
    assert not L.pending(listed(), ledger).files.limit(1).count()
    assert max(taken, default=0) <= 100  # at most partition values
    monkeypatch.undo()
    assert {r["file"].rsplit("/", 1)[1] for r in second.files.collect()} == {"late.parquet", "new.parquet"}
    assert second.rows.count() == 2
    plan = second.rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-03-25" in plan
    assert M.read_table(spark, ledger).count() == 10_002


def test_refresh_twice_is_one_rebuild(bank):
    from tallyward.plans.catalog import QUERIES

    got = {r["transaction_id"]: r for r in QUERIES["refresh_twice"](bank).collect()}
    want = {r["transaction_id"]: r for r in bank.fact_transaction.collect()}
    assert got.keys() == want.keys()
    for key, r in want.items():
        assert (got[key]["amount"], got[key]["date_key"], got[key]["is_night_transaction"]) == (r["amount"], r["date_key"], r["is_night_transaction"])
