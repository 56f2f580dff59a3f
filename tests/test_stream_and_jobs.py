"""The streaming job against the batch functions, and the four jobs end to end."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyward.ml.forest import with_forest
from tallyward.ml.iforest import IsolationForest, score_iforest, train_iforest
from tallyward.ml.training import with_probability
from tallyward.operators.features import ML_FEATURES, feature_matrix
from tallyward.operators.scoring import ModelId
from tallyward.operators.velocity import FIGURES
from tallyward.plans import jobs as J
from tallyward.plans.dims import date_range, dim_date
from tallyward.plans.facts import label_writeback
from tallyward.plans.staging import stage_realtime_transaction
from tallyward.sources.cdc import filter_ops, parse_cdc, read_cdc
from tallyward.sources.manifest import snapshot
from tallyward.streaming import job as ST


def write_lines(spark, df, path, order="value"):
    df.coalesce(1).write.mode("append").text(path)


def config(spark, bank, lake, **more):
    accounts, customers = bank.accounts.persist(), bank.customers.persist()
    return ST.StreamConfig(lake, lambda: accounts, lambda: customers,
                           clock=lambda: datetime(2024, 2, 1, 10, tzinfo=timezone.utc), **more)


def test_parse_and_filter(spark):
    lines = ['{"TransactionID": "a", "Amount": 1.5, "__op": "c"}', '{"TransactionID": "b", "__op": "d"}',
             '{"TransactionID": "c"}', '{"TransactionID": "d", "__op": "r"}', '{"TransactionID": "e", "__op": "u"}',
             '{"TransactionID": "f"', "", "7"]
    good, bad = parse_cdc(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r["TransactionID"] for r in filter_ops(good).collect()) == ["a", "c", "e"]
    assert good.filter("TransactionID = 'a'").first()["Amount"] == "1.5"
    assert {r["value"] for r in bad.collect()} == {'{"TransactionID": "f"', "", "7"}


@pytest.fixture(scope="module")
def streamed(spark, bank, tmp_path_factory):
    """The change events in three files, in event order, one micro-batch each."""
    root = tmp_path_factory.mktemp("stream")
    src, lake = str(root / "src"), str(root / "lake")
    n = F.expr("cast(regexp_extract(value, '\"TransactionID\":\\\\s*\"X(\\\\d+)', 1) as int)")
    events = bank.cdc.withColumn("n", n).persist()
    cfg = config(spark, bank, lake, hot_rows=50)
    for lo, hi in ((0, 300), (300, 301), (301, 10**9)):
        write_lines(spark, events.filter((F.col("n") >= lo) & (F.col("n") < hi)).orderBy("n").select("value"), src)
        q = ST.start(read_cdc(spark, "text", {"path": src}), cfg, str(root / "ckpt"), {"availableNow": True})
        q.awaitTermination()
    return cfg, lake, events, root


def test_stream_equals_batch(spark, bank, streamed):
    cfg, lake, _, _ = streamed
    stored = stage_realtime_transaction(ST.read_realtime(spark, lake, "realtime_transaction").withColumn(
        "_SOURCE_FILE", F.lit("x")))
    columns = ["transaction_id", *FIGURES, "combined_risk_score", "location_mismatch"]
    got = {r[0]: tuple(float(x) for x in r[1:]) for r in stored.select(*columns).collect()}
    dated = bank.featured.filter("transaction_date is not null").select(*columns)
    want = {r[0]: tuple(float(x) for x in r[1:]) for r in dated.collect()}
    assert len(got) == bank.featured.count()
    assert {k: got[k] for k in want} == want


def test_stream_outputs(spark, streamed):
    _, lake, events, _ = streamed
    detections = ST.read_realtime(spark, lake, "realtime_fraud_detection")
    assert detections.filter("risk_indication <> 'Low' or fraud_score <> '0.0'").count() == 0  # no model yet
    folders = spark.read.parquet(f"{lake}/realtime/transactions")
    assert {str(r[0]) for r in folders.select("dt").distinct().collect()} == {"2024-02-01"}
    assert folders.select("mb").distinct().count() == 3
    assert spark.read.parquet(f"{lake}/realtime/quarantine").count() == events.filter("value not like '%}'").count()


def test_replayed_batch_changes_nothing(spark, streamed):
    cfg, lake, events, _ = streamed
    before = ST.read_realtime(spark, lake, "realtime_transaction").select("TransactionID", *FIGURES)
    before = sorted(map(tuple, before.collect()))
    ST.process_batch(events.filter("n >= 301").select("value"), 2, cfg)
    after = ST.read_realtime(spark, lake, "realtime_transaction").select("TransactionID", *FIGURES)
    assert sorted(map(tuple, after.collect())) == before


def test_detections_on_the_console(spark, bank, tmp_path, capsys):
    cfg = config(spark, bank, str(tmp_path / "lake"), console=2)
    events = [_event(f"t{i}", "2024-02-01T09:00:00") for i in range(5)]
    ST.process_batch(spark.createDataFrame(events, "value string"), 0, cfg)
    out = capsys.readouterr().out
    assert "micro-batch 0 of run 0: 5 rows" in out and "only showing top 2 rows" in out and "TransactionID" in out
    assert spark.read.parquet(cfg.detections).count() == 5


def test_late_rows_are_flagged(spark, bank, tmp_path):
    def event(i, t):
        return (json.dumps({"TransactionID": i, "AccountNumber": "A1", "TransactionDate": t, "Amount": "5"}),)

    cfg = config(spark, bank, str(tmp_path / "lake"))
    first = [event("a", "2024-02-01T09:00:00"), event("b", "2024-02-01T09:30:00")]
    ST.process_batch(spark.createDataFrame(first, "value string"), 0, cfg)
    second = [event("c", "2024-02-01T09:15:00"), event("d", "2024-02-01T09:25:00")]
    ST.process_batch(spark.createDataFrame(second, "value string"), 1, cfg)
    df = spark.read.parquet(cfg.transactions)
    got = {r["TransactionID"]: (r["is_late"], r["transactions_last_1h"]) for r in df.collect()}
    assert got == {"a": ("true", "1"), "b": ("false", "2"), "c": ("true", "2"), "d": ("false", "3")}


def _event(i, t, amount="5"):
    return (json.dumps({"TransactionID": i, "AccountNumber": "A1", "TransactionDate": t, "Amount": amount}),)


def test_an_update_counts_once_over_three_batches(spark, bank, tmp_path):
    cfg = config(spark, bank, str(tmp_path / "lake"))
    for n, event in enumerate([_event("a", "2024-02-01T09:00:00"), _event("a", "2024-02-01T09:01:00", "7"),
                               _event("c", "2024-02-01T09:02:00", "1")]):
        ST.process_batch(spark.createDataFrame([event], "value string"), n, cfg)
    c = spark.read.parquet(cfg.transactions).filter("TransactionID = 'c'").first()
    assert (c["transactions_last_1h"], float(c["amount_last_1h"])) == ("2", 8.0)


def test_events_without_id_are_quarantined_and_runs_kept_apart(spark, bank, tmp_path):
    lake = str(tmp_path / "lake")
    cfg = config(spark, bank, lake)
    rows = [_event(None, "2024-02-01T09:00:00"), _event(" ", "2024-02-01T09:00:00"), _event("a", "2024-02-01T09:00:00")]
    ST.process_batch(spark.createDataFrame(rows, "value string"), 0, cfg)
    assert spark.read.parquet(cfg.quarantine).count() == 2
    again = config(spark, bank, lake, run="1")
    ST.process_batch(spark.createDataFrame([_event("b", "2024-02-01T09:01:00")], "value string"), 0, again)
    assert {r[0] for r in spark.read.parquet(cfg.transactions).select("TransactionID").collect()} == {"a", "b"}


def test_running_job_reads_no_history(spark, bank, tmp_path, monkeypatch):
    """A replay, a late row and a replay after expiry, each in a run that continues the checkpoint."""
    monkeypatch.setattr(ST, "stored_history", lambda *_: pytest.fail("stored rows read"))
    src = tmp_path / "src"
    src.mkdir()
    lake = str(tmp_path / "lake")

    def send(n, *events, **ring):
        (src / f"{n}.txt").write_text("".join(e[0] + "\n" for e in events))
        cfg = config(spark, bank, lake, ring=ring)
        ST.start(read_cdc(spark, "text", {"path": str(src)}), cfg, str(tmp_path / "ckpt"), {"availableNow": True}).awaitTermination()
        rows = spark.read.parquet(f"{lake}/realtime/transactions").select("mb", "TransactionID", "is_late", "transactions_last_1h", "amount_last_1h")
        return {r["TransactionID"]: (r["is_late"], r["transactions_last_1h"], float(r["amount_last_1h"]))
                for r in rows.filter(F.col("mb") == n).collect()}

    a, b = _event("a", "2024-02-01T09:00:00"), _event("b", "2024-02-01T09:30:00", "7")
    assert send(0, a, b, a) == {"a": ("true", "1", 5.0), "b": ("false", "2", 12.0)}
    # The replay of b goes; the late row c stays, flagged, and counts from then on.
    assert send(1, b, _event("c", "2024-02-01T09:15:00", "1")) == {"c": ("true", "2", 6.0)}
    assert send(2, a, b) == {}  # nothing but replays: nothing is written
    # After its time to live a replay is an update: it is written again and counts once.
    assert send(3, b, _event("d", "2024-02-01T09:40:00", "2"), replay_hours=0) == {"b": ("false", "3", 13.0), "d": ("false", "4", 15.0)}
    assert {r["TransactionID"] for r in ST.read_realtime(spark, lake, "realtime_fraud_detection").select("TransactionID").collect()} == set("abcd")


def test_replays_are_dropped_in_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    line = json.dumps({"TransactionID": "a", "TransactionDate": "2024-02-01T09:00:00"})
    spark.createDataFrame([(line,), (line,), (line.replace('"a"', '"b"'),)], "value string").write.text(src)
    stream = ST.drop_replays(read_cdc(spark, "text", {"path": src}))
    (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
     .trigger(availableNow=True).start(out).awaitTermination())
    assert spark.read.schema("value string").parquet(out).count() == 2


@pytest.fixture(scope="module")
def forest(bank):
    matrix = feature_matrix(bank.featured).persist()
    return train_iforest(matrix, ML_FEATURES, trees=40, psi=64), matrix


def test_isolation_forest(spark, forest, tmp_path_factory):
    model, matrix = forest
    path = str(tmp_path_factory.mktemp("model"))
    model.save(spark, path)
    again = IsolationForest.load(spark, path)
    a = score_iforest(matrix, model).select("transaction_id", "raw_score", "is_outlier")
    b = score_iforest(matrix, again).select("transaction_id", "raw_score", "is_outlier")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    share = a.agg(F.avg(F.col("is_outlier").cast("double"))).first()[0]
    assert 0.02 < share < 0.08
    per_tree = model.nodes[model.nodes["node"] == 0]
    assert len(per_tree) == 40 and (per_tree["size"] == 64).all()
    leaves = model.nodes[model.nodes["feature"] < 0].groupby("tree")["size"].sum()
    assert (leaves == 64).all()


def test_isolation_forest_finds_a_planted_outlier(spark):
    df = spark.range(2000).selectExpr("cast(id as string) as transaction_id",
                                      "if(id = 77, 50.0, (id * 7919 % 1000) / 1000) as x",
                                      "if(id = 77, -50.0, (id * 104729 % 1000) / 1000) as y")
    model = train_iforest(df, ["x", "y"], trees=50, psi=128, contamination=0.01)
    top = score_iforest(df, model).orderBy(F.desc("raw_score")).first()
    assert top["transaction_id"] == "77" and top["is_outlier"]


def test_jobs_end_to_end(spark, bank, streamed, tmp_path_factory):
    _, lake, _, root = streamed
    days = {"B1": "2024-01-14", "B2": "2024-01-15"}

    def warehouse(batch):
        def reader(table):
            df = bank.raw(table)
            if table == "transaction":
                return df
            return df.filter(F.col("_BATCH_ID") == batch)

        return J.Warehouse(spark, lake, days[batch], f"{days[batch]} 12:00:00", batch, reader, ModelId("tally", "v1"))

    first = J.initial_load(warehouse("B1"))
    report = {(r["model"], r["column_name"], r["test"]): r["n_failures"] for r in first["report"].collect()}
    assert all(n == 0 for (m, c, t), n in report.items() if t in ("unique", "accepted_values", "relationships"))
    n_fact = first["fact_transaction"].count()

    w = warehouse("B2")
    second = J.batch_refresh(w)
    customers = second["dim_customer"]
    changed = customers.filter("not is_current").count()
    assert 0 < changed < customers.filter("is_current").count()
    assert customers.filter("not is_current and expiry_date <> date'2024-01-14'").count() == 0
    assert customers.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("n")).filter("n <> 1").count() == 0
    assert w.read("fact_transaction").count() == n_fact
    assert w.read("fact_account_balance_snapshot").select("snapshot_date_key").distinct().count() == 2

    for _ in range(2):  # the second run finds no new files
        third = J.realtime_refresh(w)
        assert third["fact_transaction"].count() == n_fact
        assert third["fact_fraud_detection"].count() == third["fact_transaction"].join(
            ST.read_realtime(spark, lake, "realtime_transaction").select(F.col("TransactionID").alias("transaction_id")),
            "transaction_id", "left_semi").count()

    mode, model, _ = J.retrain(w, "auto", trees=20)
    assert mode == "unsupervised" and w.read("model_registry").count() == 1
    labelled = label_writeback(w.read("fact_transaction"), bank.decisions, "2024-02-01", "ANALYST")
    J.write_back(J.Warehouse(spark, lake, "2024-02-01", w.now, "B2"), bank.decisions)
    assert w.read("fact_transaction").filter("is_fraud_confirmed is not null").count() == labelled.filter(
        "is_fraud_confirmed is not null").count()
    J.tidy(w)
    w.model_id = ModelId("tally", "v2")
    mode, model, metrics = J.retrain(w, "auto", min_labels=200, trees=10)
    registry = {r["model_version"]: r for r in w.read("model_registry").collect()}
    assert mode == "supervised" and 0 < metrics["auc_roc"] < 1
    assert registry["v2"]["is_active"] and not registry["v1"]["is_active"]
    assert registry["v2"]["algorithm"] == "RandomForestClassifier"
    compiled = J.saved_model(w)
    rows = w.read("training_labelled").limit(200)
    got = {r[0]: r[1] for r in with_forest(rows, compiled).select("transaction_id", "raw_score").collect()}
    want = {r[0]: r[1] for r in with_probability(rows, model).select("transaction_id", "raw_score").collect()}
    assert got == pytest.approx(want)
    assert sorted(J.staging_views(w))[0] == "stg_account"
    assert spark.sql("select count(distinct account_number) = count(*) from stg_account").first()[0]


def test_refresh_merges_what_the_stream_wrote_meanwhile(spark, bank, tmp_path, monkeypatch):
    lake = str(tmp_path / "the lake")
    accounts, customers = bank.accounts.persist(), bank.customers.persist()

    def write(i, hour, run):
        cfg = ST.StreamConfig(lake, lambda: accounts, lambda: customers, run=run,
                              clock=lambda: datetime(2024, 2, 1, hour, tzinfo=timezone.utc))
        ST.process_batch(spark.createDataFrame([_event(i, "2024-02-01T05:00:00")], "value string"), 0, cfg)

    def meanwhile(*args, make=J.build):
        if args[1].endswith("fact_transaction") and not (tmp_path / "the lake/realtime/stamps/run=b c").exists():
            write("s2", 7, "b c")  # a run that lags by hours
        make(*args)

    monkeypatch.setattr(J, "build", meanwhile)
    write("s1", 10, "a")
    w = J.Warehouse(spark, lake, "2024-02-01", "2024-02-01 12:00:00", "B1",
                    lambda t: bank.raw(t).filter("_BATCH_ID = 'B1'"), ModelId("tally", "v1"))
    facts = ("fact_transaction", "fact_fraud_detection")
    known = lambda: [{r[0] for r in w.read(f).filter("transaction_id like 's_'").select("transaction_id").collect()} for f in facts]
    J.initial_load(w)
    assert known() == [{"s1"}] * 2
    rows = J._realtime(w, "realtime_transaction")
    assert [r["TransactionID"] for r in J._new_realtime(w, rows, facts[0], False).rows.collect()] == ["s2"]
    J.batch_refresh(w)
    assert known() == [{"s1", "s2"}] * 2
    assert J._new_realtime(w, J._realtime(w, "realtime_transaction"), facts[0], False).is_empty()
    before = [snapshot(spark, w.base(f)).number for f in facts]
    J.realtime_refresh(w)  # what a batch has merged, the stream's refresh need not merge again
    assert [snapshot(spark, w.base(f)).number for f in facts] == before


def test_dim_date(spark):
    d = dim_date(date_range(spark, "2024-02-26", "2024-03-01")).orderBy("date_key").collect()
    assert [r["date_key"] for r in d] == [20240226, 20240227, 20240228, 20240229, 20240301]
    assert d[3]["is_month_end"] and str(d[3]["week_start"]) == "2024-02-26" and d[4]["quarter"] == 1
