"""RAW loads, merges, Type-2 history, quality tests and metrics."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyward.ml import metrics as M
from tallyward.operators import quality as Q
from tallyward.operators import scd2 as S
from tallyward.operators.dedup import latest_per_key
from tallyward.operators.enrich import two_tier_lookup
from tallyward.plans import catalog as CT
from tallyward.plans import facts as FT
from tallyward.plans.staging import stage_batch
from tallyward.plans import warehouse as WH
from tallyward.session import cut_lineage
from tallyward.schemas import BATCH_COLUMNS, NEVER_EXTRACTED, RAW_LOCATIONS, RAW_SCHEMAS
from tallyward.sources import raw as R
from tallyward.sources import sinks as K
from tallyward.sources.adapter import cdc_events


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_schemas():
    assert len(RAW_SCHEMAS) == len(RAW_LOCATIONS) == 14
    assert not set(NEVER_EXTRACTED) & set(BATCH_COLUMNS["card"])
    assert all(f.dataType.simpleString() == "string" for s in RAW_SCHEMAS.values() for f in s.fields)


def test_extract_goes_on_after_a_failure(spark, bank, tmp_path):
    def reader(table):
        if table == "loan":
            raise ValueError("no such table")
        df = bank.raw(table)
        return df.withColumn("CVV", F.lit("123")) if table == "card" else df

    out = R.extract_all(spark, reader, str(tmp_path), "B7", "2024-01-01", ["card", "loan", "branch"])
    got = {r["table"]: (r["n_rows"], r["status"]) for r in out.collect()}
    assert got["loan"] == (-1, "FAILED") and got["branch"][1] == "SUCCESS" and got["card"][0] > 0
    stored = spark.read.parquet(f"{tmp_path}/card/batch_B7")
    assert "CVV" not in stored.columns and stored.filter("length(_ROW_HASH) <> 64").count() == 0


def test_load_raw_by_name_and_past_bad_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("concat('B', id) as branchid", "'x' as extra").write.parquet(path)
    with open(os.path.join(path, "broken.parquet"), "wb") as f:
        f.write(b"not parquet")
    df = R.load_raw(spark, path, RAW_SCHEMAS["branch"], on_error="continue")
    assert rows(df.select("BranchID", "City")) == [("B0", None), ("B1", None), ("B2", None)]
    with pytest.raises(Exception):
        R.load_raw(spark, path, RAW_SCHEMAS["branch"]).collect()


def test_files_are_loaded_once(spark, tmp_path):
    src, ckpt, seen = str(tmp_path / "src"), str(tmp_path / "ckpt"), []
    schema = spark.range(1).selectExpr("cast(id as string) x").schema

    def sink(df, _):
        seen.append(sorted(r[0] for r in df.collect()))

    for n in (2, 3):
        spark.range(n).selectExpr("cast(id as string) x").coalesce(1).write.mode("append").parquet(src)
        R.load_new_files(spark, src, schema, ckpt, sink)
    R.load_new_files(spark, src, schema, ckpt, sink)
    assert seen == [["0", "1"], ["0", "1", "2"]]


def test_latest_is_deterministic_on_ties(spark):
    a = [("k", "1", "t"), ("k", "2", "t"), ("k", "3", "s"), ("j", "9", None)]
    picks = {rows(latest_per_key(spark.createDataFrame(p, "k string, v string, t string").repartition(n), "k",
                                 [F.col("t").desc_nulls_last()]).select("k", "v"))[1]
             for p in (a, a[::-1]) for n in (1, 3)}
    assert len(picks) == 1 and picks.pop()[1] in ("1", "2")


def test_latest_prunes_before_the_shuffle(bank):
    plan = bank.stg("account")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_register_model(spark):
    reg = spark.createDataFrame([("m", "1", True), ("m", "0", False)], "n string, v string, is_active boolean")
    new = spark.createDataFrame([("m", "2", False)], "n string, v string, is_active boolean")
    assert rows(K.register_model(reg, new)) == [("m", "0", False), ("m", "1", False), ("m", "2", True)]


SNAP = "k string, scd2_hash string, snapshot_date date, load_ts string"


def test_history_and_apply(spark):
    d = [date(2024, 1, n) for n in (1, 2, 3, 4)]
    snaps = [("a", "x", d[0], "1"), ("a", "x", d[1], "1"), ("a", "y", d[2], "1"), ("a", "z", d[2], "2"),
             ("b", "p", d[0], "1"), ("b", "q", d[1], "1"), ("b", "p", d[3], "1")]
    df = spark.createDataFrame(snaps, SNAP)
    h = S.scd2_history(df, "k").select("k", "scd2_hash", "effective_date", "expiry_date", "is_current")
    want = [("a", "x", d[0], d[1], False), ("a", "z", d[2], None, True), ("b", "p", d[0], d[0], False),
            ("b", "p", d[3], None, True), ("b", "q", d[1], d[2], False)]
    assert rows(h) == sorted(want, key=str)

    dim = S.scd2_history(df.filter("snapshot_date = '2024-01-01'"), "k")
    for day in d[1:]:
        staged = latest_per_key(df.filter(F.col("snapshot_date") == day), "k", [F.col("load_ts").desc()])
        staged = staged.select("k", "scd2_hash")
        for _ in range(2):  # applying the same day again changes nothing
            dim = cut_lineage(S.scd2_apply(dim, staged, "k", str(day)))
    assert rows(dim.select("k", "scd2_hash", "effective_date", "expiry_date", "is_current")) == sorted(want, key=str)


def test_second_change_on_a_day_replaces_the_first(spark):
    dim = spark.createDataFrame([("a", "x", date(2024, 1, 1), None, True)],
                                "k string, scd2_hash string, effective_date date, expiry_date date, is_current boolean")
    for h in ("y", "z"):
        dim = S.scd2_apply(dim, spark.createDataFrame([("a", h)], "k string, scd2_hash string"), "k", "2024-01-05")
    assert rows(dim) == [("a", "x", date(2024, 1, 1), date(2024, 1, 4), False), ("a", "z", date(2024, 1, 5), None, True)]


def test_point_in_time_covers_boundary_days(spark):
    h = spark.createDataFrame([("a", 1, date(2024, 1, 1), date(2024, 1, 4)), ("a", 2, date(2024, 1, 5), None)],
                              "k string, v int, effective_date date, expiry_date date")
    f = spark.sql("""select * from values ('a', timestamp'2024-01-04 23:59:59'), ('a', timestamp'2024-01-05 00:00:00'),
        ('a', timestamp'2023-12-31 00:00:00'), ('b', timestamp'2024-01-05 00:00:00') t(k, ts)""")
    got = S.point_in_time_join(f, h, "k", "ts", ["v"])
    assert [r["v"] for r in got.orderBy("ts", "k").collect()] == [None, 1, 2, None]


def test_two_tiers_take_a_hit_whole(spark):
    s = "k string, a int, b int"
    fresh = spark.createDataFrame([("x", None, 2)], s)
    base = spark.createDataFrame([("x", 7, 8), ("y", 9, 9)], s)
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    assert rows(two_tier_lookup(df, fresh, base, "k")) == [
        ("x", None, 2, "fresh"), ("y", 9, 9, "base"), ("z", None, None, "miss")]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", 4)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(Q.not_null(df, "k")) == [(None, 3)]
    assert rows(Q.unique(df, "k")) == [("a", 2)]
    assert rows(Q.accepted_values(df, "k", ["a"])) == [("c", 1)]
    assert rows(Q.relationships(df, "k", parent, "id")) == [("c", 1)]
    report = Q.dq_report(Q.column_checks("m", df, {"k": ("not_null", "unique"), "v": ("unique",)}))
    assert rows(report.select("column_name", "test", "n_failures", "passed")) == [
        ("k", "not_null", 1, False), ("k", "unique", 1, False), ("v", "unique", 0, True)]


def test_metrics(spark):
    import random

    rng = random.Random(1)
    data = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(data, "fraud_score double, label int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for bands in (1, 7, 1000):
        assert M.auc_roc(df, bands=bands).first()["auc_roc"] == pytest.approx(auc, abs=1e-6)
    report = {r["label"]: r for r in M.classification_report(
        df.withColumn("prediction", (F.col("fraud_score") > 0.5).cast("int"))).collect()}
    tp = sum(s > 0.5 for s in pos)
    assert report[1]["support"] == len(pos)
    assert report[1]["precision"] == pytest.approx(tp / (tp + sum(s > 0.5 for s in neg)), abs=1e-6)
    assert report[1]["recall"] == pytest.approx(tp / len(pos), abs=1e-6)


def test_hot_keys_of_a_join_are_split(spark):
    """A key with a third of the rows is spread over several tasks by the session's settings."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 60000, 1, 16).selectExpr("if(id % 3 = 0, 0, id) as k", "uuid() as pad")
        dim = spark.range(0, 60000, 1, 4).selectExpr("id as k", "id * 2 as v")
        q = fact.join(dim, "k", "left").agg(F.count("v"), F.max("pad"))
        assert q.collect()[0][0] == 60000
        assert "SortMergeJoin(skew=true)" in q._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)


def test_staging_drops_blank_keys_and_other_batches(bank):
    stg = stage_batch("customer", bank.raw("customer"), "B1", "2024-02-01")
    assert stg.filter("trim(customer_id) = '' or customer_id is null").count() == 0
    assert stg.count() == bank.table("customer").count()


def test_publish_switches_versions(spark, tmp_path):
    from tallyward.sources.sinks import current_path, publish

    path = str(tmp_path / "dim")
    for n in range(3):
        old = spark.read.parquet(current_path(spark, path)) if n else None
        one = spark.range(n, n + 1)
        publish(old.unionByName(one) if n else one, path)
    assert sorted(r[0] for r in spark.read.parquet(current_path(spark, path)).collect()) == [0, 1, 2]


def test_unreadable_files_fail_or_are_named(spark, tmp_path):
    from pyspark.sql import types as T

    from tallyward.sources.raw import load_raw, skipped_files

    schema = T.StructType([T.StructField("a", T.StringType())])
    spark.createDataFrame([("x",)], schema).coalesce(1).write.parquet(str(tmp_path / "raw"))
    (tmp_path / "raw" / "broken.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        load_raw(spark, str(tmp_path / "raw"), schema).collect()
    assert load_raw(spark, str(tmp_path / "raw"), schema, "continue").count() == 1
    assert [r["file"].rsplit("/", 1)[1] for r in skipped_files(spark, str(tmp_path / "raw"), schema).collect()] == ["broken.parquet"]


def test_stream_rows_for_facts_need_no_sliding_figures(bank):
    from tallyward.plans import facts as FT

    lean, staged = bank.realtime_source, FT.realtime_source(bank.stg_realtime)
    assert "is_row" not in lean._jdf.queryExecution().optimizedPlan().toString()
    assert "is_row" in staged._jdf.queryExecution().optimizedPlan().toString()
    assert lean.exceptAll(staged).count() == 0 and staged.exceptAll(lean).count() == 0


def test_events_of_one_row_group_are_dealt_to_several_tasks(spark, tmp_path):
    spark.range(20000).selectExpr(
        "id as event_id", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts", "id % 40 as user_id",
        "'view' as event_type", "cast(id % 900 as double) / 4 as value", "'{}' as props",
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(40).selectExpr("id as c_custkey", "id % 25 as c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(small, "4k")
    try:
        sizes = [r["count"] for r in cdc_events(spark, str(tmp_path)).select(
            F.spark_partition_id().alias("p"), "value").groupBy("p").agg(
                F.count("*").alias("count"), F.max(F.length("value"))).collect()]
    finally:
        spark.conf.unset(small)
    assert sum(sizes) == 20000 and len(sizes) > 1 and max(sizes) < 15000


def test_dq_report_stores_only_tested_columns(bank, monkeypatch):
    """Whole facts were stored, and the rows both consist of were made twice."""
    stored = []
    monkeypatch.setattr(CT, "cut_lineage", lambda df: stored.append(df.columns) or df)
    CT.dq_report(bank)
    assert stored == [
        ["transaction_id", "amount", "customer_id", "account_number", "transaction_type_id", "merchant_id", "atm_id", "card_number_hashed"],
        ["transaction_id", "amount", "customer_key", "account_key", "merchant_key", "atm_key"],
        ["transaction_id", "fraud_score", "risk_indication", "action_taken", "model_key"]]
    assert WH.tested_columns("dim_branch") == ["branch_key", "branch_id"]
    rows, others = FT.only_columns(FT.one_row_each(bank.sources), ("transaction_id", "amount", *[on for _, on, _, _ in FT.LINKS]))
    fact = FT.fact_transaction(rows.withColumns(others), bank.dims, bank.now, chosen=True)
    assert fact.dtypes == bank.fact_transaction.dtypes
