"""Named queries, one per operator of the inventory. Each takes a Bank."""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import dates as FD
from tallyward.functions import keys as K
from tallyward.functions import parsing as P
from tallyward.ml import metrics as M
from tallyward.ml import training as TR
from tallyward.ml.forest import SHAPE_SCHEMA, TreeForest, fit_nodes
from tallyward.ml.iforest import (
    NODE_SCHEMA, IsolationForest, grow_trees, sample_rows, score_iforest, train_iforest,
)
from tallyward.operators import enrich as E
from tallyward.operators import features as FE
from tallyward.operators import quality as Q
from tallyward.operators import scd2 as S2
from tallyward.operators import scoring as SC
from tallyward.operators import velocity as V
from tallyward.operators.dedup import by_priority, latest_per_key
from tallyward.plans import analytics as Z
from tallyward.plans import facts as FT
from tallyward.plans.bank import Bank
from tallyward.plans.warehouse import MODEL_TESTS, tested_columns, warehouse_checks
from tallyward.schemas import BATCH_COLUMNS, RAW_SCHEMAS
from tallyward.session import checkpoint_dir, cut_lineage
from tallyward.sources import adapter as A
from tallyward.sources import cdc as C
from tallyward.sources import manifest as MF
from tallyward.sources import raw as R
from tallyward.sources import sinks as K2
from tallyward.plans.staging import BATCH_MODELS
from tallyward.streaming import keyed as KY

MICROBATCHES = 4

# Training results per session and input, so that three queries share one training.
_TRAINED: dict = {}


def present(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as doubles, times and dates as text."""
    def plain(f):
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("etl_load_timestamp")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- sources and sinks -----------------------------------------------------------------
def load_raw_transaction(b: Bank) -> DataFrame:
    """Write the RAW table as Parquet text and load it back by declared schema."""
    root = f"{checkpoint_dir(b.spark)}/tallyward_raw/{b.sf_dir.strip('/').replace('/', '_')}"
    path = K2.write_raw(K2.stringify(b.raw("transaction")), root, "transaction", A.BATCH)
    return R.load_raw(b.spark, path, RAW_SCHEMAS["transaction"]).drop("_ROW_HASH", "_SOURCE_SYSTEM")


def load_summary(b: Bank) -> DataFrame:
    return _union([R.load_summary(b.raw(n), n, BATCH_MODELS[n][0], "_BATCH_ID") for n in BATCH_COLUMNS])


def load_totals(b: Bank) -> DataFrame:
    return R.load_totals(load_summary(b))


def etl_metadata(b: Bank) -> DataFrame:
    source = b.raw("transaction").select("TransactionID", "AccountNumber", "Amount", "Channel", "_LOAD_TS")
    return K2.with_etl_metadata(source.withColumnRenamed("_LOAD_TS", "SentAt"), "B9", "CORE", A.NOW)


def detections_split(b: Bank) -> DataFrame:
    return SC.split_streams(b.scored_runs, SC.ModelId())[1]


def merge_upsert(b: Bank) -> DataFrame:
    columns = ["transaction_id", "amount", "channel", "source_priority"]
    return K2.merge_upsert(b.batch_source.select(*columns), b.realtime_source.select(*columns), "transaction_id")


def merge_keeps_labels(b: Bank) -> DataFrame:
    """A labelled fact table, merged with newer rows of all its transactions that bring no labels."""
    newer = b.fact_with().withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    merged = K2.merge_upsert(b.labelled_with(), newer, "transaction_id", FT.LABELS)
    return merged.select("transaction_id", "amount", *FT.LABELS)


def refresh_twice(b: Bank) -> DataFrame:
    """Load, labels, a stream update, an older file that comes late, a second batch: what a full
    rebuild gives, since a merge knows which row is newer."""
    path = f"{checkpoint_dir(b.spark)}/refresh-{uuid.uuid4().hex}"

    def fact(source: DataFrame, name: str) -> DataFrame:
        FT.fact_transaction(source, b.dims, b.now, versioned=True).write.parquet(f"{path}/{name}")
        return b.spark.read.parquet(f"{path}/{name}")

    batch, stream = fact(b.batch_source, "batch"), fact(b.realtime_source, "stream")
    late = stream.withColumns({
        "amount": (F.col("amount") * 3).cast("decimal(18,2)"), "source_load_ts": F.col("source_load_ts") - F.expr("INTERVAL 1 DAY")})

    def merge(rows: DataFrame) -> None:
        MF.merge_table(rows, f"{path}/fact", "transaction_id", "date_key", FT.LABELS, FT.VERSION)

    MF.rebuild_table(batch, f"{path}/fact", "date_key")
    merge(FT.label_writeback(MF.read_table(b.spark, f"{path}/fact"), b.decisions, b.as_of, "ANALYST", decided_only=True))
    for rows in (stream, late, batch):
        merge(rows)
    return MF.read_table(b.spark, f"{path}/fact").select(
        "transaction_id", "date_key", "customer_key", "amount", "is_night_transaction", "source_priority", *FT.LABELS)


def scd2_three_loads(b: Bank) -> DataFrame:
    """Customers loaded, changed and changed back: no two versions share a key."""
    def load(batch: str, day: str) -> DataFrame:
        staged = b.stg("customer", batch).select("customer_id", "city", "scd2_hash")
        day_ = F.lit(day).cast("date")
        return staged.withColumn("customer_key", K.surrogate_key("customer_id", "scd2_hash", day_))

    dim = load("B1", "2023-12-31").withColumns({
        "effective_date": F.lit("2023-12-31").cast("date"), "expiry_date": F.lit(None).cast("date"),
        "is_current": F.lit(True)})
    for batch, day in (("B2", "2024-01-15"), ("B1", "2024-01-31")):
        dim = S2.scd2_apply(dim, load(batch, day), "customer_id", day)
    return dim


def register_model(b: Bank) -> DataFrame:
    row = TR.registry_row(b.spark, "tally-rules", "v3", "Rules", A.AS_OF, 0.5, 0, {"auc_roc": 0.5})
    out = K2.register_model(b.model, row)
    return out.select("model_name", "model_version", "is_active", "algorithm", "training_date",
                      "threshold_score", "auc_roc")


# ---- filters ---------------------------------------------------------------------------
def cdc_parse(b: Bank) -> DataFrame:
    good, bad = C.parse_cdc(b.cdc)
    a = good.agg(F.count("*").alias("n_rows")).select(F.lit("parsed").alias("outcome"), "n_rows")
    z = bad.agg(F.count("*").alias("n_rows")).select(F.lit("quarantined").alias("outcome"), "n_rows")
    return a.unionByName(z)


def incremental_since(b: Bank) -> DataFrame:
    """Detections newer than the newest one of model v1."""
    loaded = b.stg_detection.filter("model_version = 'v1'")
    new = R.since(b.stg_detection, "processing_timestamp", loaded, "processing_timestamp")
    return new.select("transaction_id", "processing_timestamp", "model_version", "fraud_score")


# ---- joins -----------------------------------------------------------------------------
def enrich_account(b: Bank) -> DataFrame:
    df = E.enrich_account(b.transactions, b.accounts)
    return df.select("transaction_id", "account_number", "customer_id", "event_customer_id",
                     "account_type", "account_status", "current_balance", "available_balance",
                     "account_open_date", "last_activity_date", "branch_id", "account_currency",
                     "interest_rate", "minimum_balance", "overdraft_limit")


def enrich_customer(b: Bank) -> DataFrame:
    return b.still.select(
        "transaction_id", "customer_id", "customer_first_name", "customer_last_name",
        "customer_email", "customer_dob", "customer_gender", "customer_occupation",
        "customer_city", "customer_state", "customer_country", "customer_segment",
        "customer_since", "customer_is_active", "customer_created_date")


def two_tier_lookup(b: Bank) -> DataFrame:
    fields = ["account_number", "account_status", "balance"]
    fresh = b.stg("account").filter("account_status = 'Dormant'").select(*fields)
    base = b.stg("account", A.FIRST_BATCH).select(*fields)
    return E.two_tier_lookup(b.stg("transaction").select("transaction_id", "account_number"),
                             fresh, base, "account_number")


def training_base(b: Bank) -> DataFrame:
    return TR.training_base(b.transactions, b.accounts, b.customers).select(
        "transaction_id", "account_number", "customer_id", "amount", "transaction_date",
        "current_balance", "account_status", "customer_segment", "customer_city", "customer_since")


def scd2_changes(b: Bank) -> DataFrame:
    before = b.stg("customer", A.FIRST_BATCH)
    changed = S2.scd2_changes(b.stg("customer"), before, "customer_id")
    return changed.select("customer_id", "city", "occupation", "scd2_hash")


def point_in_time_join(b: Bank) -> DataFrame:
    fact = E.enrich_account(b.transactions, b.accounts).filter("transaction_date is not null").select(
        "transaction_id", "customer_id", "transaction_date")
    return S2.point_in_time_join(fact, b.customer_history, "customer_id", "transaction_date",
                                 ["city", "effective_date"])


def training_labelled(b: Bank) -> DataFrame:
    return TR.labelled_matrix(FE.feature_matrix(b.featured), R.labels(b.labelled_with()))


# ---- windows ---------------------------------------------------------------------------
def dedup_latest(b: Bank) -> DataFrame:
    raw = b.raw("transaction").filter(~P.is_blank("TransactionID"))
    return latest_per_key(raw, "TransactionID", [F.col("_LOAD_TS").desc()]).select(
        "TransactionID", "_LOAD_TS", "Amount")


def dedup_priority(b: Bank) -> DataFrame:
    return by_priority(b.sources, "transaction_id", "source_priority", "load_ts").select(
        "transaction_id", "source_priority", "load_ts", "amount")


def dedup_latest_detection(b: Bank) -> DataFrame:
    return FT.latest_detection(b.stg_detection).select(
        "transaction_id", "processing_timestamp", "fraud_score", "model_version")


def velocity_1h_24h(b: Bank) -> DataFrame:
    return b.moving.select("transaction_id", "account_number", "transaction_date", "amount", *V.FIGURES)


def velocity_microbatches(b: Bank) -> DataFrame:
    """The change events by event time in MICROBATCHES files, each followed by repeats of the file
    before, through the keyed stream; the last output of every dated transaction. State and files lie
    below the checkpoint folder."""
    root = f"{checkpoint_dir(b.spark)}/microbatches-{uuid.uuid4().hex}"
    at = P.parse_datetime(F.get_json_object("value", "$.TransactionDate"))
    timed = b.cdc.withColumn("_at", F.coalesce(F.unix_micros(at), F.lit(0)))
    cuts = timed.agg(F.percentile_approx("_at", [i / MICROBATCHES for i in range(1, MICROBATCHES)], 10_000)).first()[0] or []
    part = reduce(lambda x, cut: x + (F.col("_at") > cut).cast("int"), cuts, F.lit(0))
    parts = timed.select("value", part.alias("part"))
    again = parts.filter(F.xxhash64("value") % 5 == 0).select("value", (F.col("part") + 1).alias("part"))
    parts.union(again).write.partitionBy("part").text(f"{root}/events")
    out = f"{root}/figures"
    for i in range(MICROBATCHES + 1):  # a file group each; every run goes on where the last one stopped
        source = f"{root}/source/{i}"
        b.spark.read.text(f"{root}/events/part={i}").write.text(source)
        figures = KY.keyed_figures(C.read_cdc(b.spark, "text", {"path": f"{root}/source/*"}))
        (KY.with_state_store(b.spark, figures.writeStream).format("parquet").option("path", out)
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    rows = b.spark.read.schema(figures.schema).parquet(out).filter("counted")
    typed = E.live_transactions(C.parse_cdc(rows)[0]).select("transaction_id", "account_number", "transaction_date", "amount")
    keyed = rows.select(F.trim(F.get_json_object("value", "$.TransactionID")).alias("transaction_id"), *V.FIGURES)
    return typed.filter("transaction_date is not null").join(keyed, "transaction_id")


def velocity_defaults(b: Bank) -> DataFrame:
    return b.moving.filter(P.is_blank("account_number")).select("transaction_id", "amount", *V.FIGURES)


def scd2_history(b: Bank) -> DataFrame:
    return b.customer_history


def scd2_apply(b: Bank) -> DataFrame:
    first = S2.scd2_history(b.snapshot("B1"), "customer_id")
    return S2.scd2_apply(first, b.stg("customer"), "customer_id", "2024-01-15")


# ---- set operations and aggregates -----------------------------------------------------
def union_sources(b: Bank) -> DataFrame:
    return b.sources.select("transaction_id", "account_number", "customer_id", "amount",
                            "transaction_hour", "is_night_transaction", "load_ts", "source_priority")


def velocity_quality(b: Bank) -> DataFrame:
    return V.velocity_quality(b.moving)


def _judged(b: Bank) -> DataFrame:
    scores = FT.latest_detection(b.stg_detection).select("transaction_id", "fraud_score", "is_fraud_predicted")
    labels = b.decisions.filter("is_confirmed_fraud is not null").select(
        "transaction_id", F.col("is_confirmed_fraud").cast("int").alias("label"))
    return scores.join(labels, "transaction_id").withColumn(
        "prediction", F.col("is_fraud_predicted").cast("int"))


def dimension_health(b: Bank) -> DataFrame:
    frozen = b.accounts.filter("account_status = 'Closed'")
    return E.dimension_health({"account": b.accounts, "customer": b.customers, "closed_account": frozen})


# ---- scalar functions ------------------------------------------------------------------
def scalar_suite(b: Bank) -> DataFrame:
    a = b.raw("account").filter("_BATCH_ID = 'B2'")
    as_of = F.lit(A.AS_OF).cast("date")
    opened, balance = P.day("OpenDate"), P.number("Balance")
    return a.select(
        P.text("AccountNumber").alias("account_number"), F.col("_LOAD_TS").alias("load_ts"),
        P.upper_text("Currency").alias("currency"), P.blank_to_null("AccountNumber").alias("key_or_null"),
        F.concat(P.text("AccountType"), F.lit(" "), P.text("OverdraftLimit")).alias("joined"),
        balance.alias("balance"), P.whole("Balance").alias("whole_balance"), P.real("Balance").alias("real_balance"),
        opened.alias("open_date"), P.any_day("LastActivityDate").alias("last_activity"),
        P.parse_datetime("ModifiedDate").alias("modified"), P.flag("OverdraftLimit").alias("has_flag"),
        K.card_hash("AccountNumber").alias("sha"), K.change_hash("AccountType", "OverdraftLimit").alias("md5"),
        K.surrogate_key("AccountNumber", "OverdraftLimit").alias("surrogate"), K.date_key(opened).alias("date_key"),
        F.hour(P.parse_datetime("CreatedDate")).alias("hour"),
        FD.year_boundaries(opened, as_of).alias("years"), FD.month_boundaries(opened, as_of).alias("months"),
        FD.age_band(opened, as_of).alias("band"), F.abs(balance).alias("abs_balance"),
        F.col("AccountType").like("%ing%").alias("is_like"), F.coalesce("OverdraftLimit", F.lit("0")).alias("or_zero"),
        P.safe_double("Balance").alias("safe_real"), P.safe_int("Balance").alias("safe_whole"))


def parse_datetime_suite(b: Bank) -> DataFrame:
    """Each event's time in one of twelve spellings, parsed back."""
    e = b.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    text = F.expr(f"""case event_id % 12
        when 0 then cast(unix_micros(ts) * 1000 as string)
        when 1 then cast(unix_micros(ts) as string)
        when 2 then cast(unix_millis(ts) as string)
        when 3 then cast(unix_seconds(ts) as string)
        when 4 then {iso}
        when 5 then date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
        when 6 then concat({iso}, 'Z')
        when 7 then concat({iso}, '+02:00')
        when 8 then date_format(ts, 'yyyy-MM-dd')
        when 9 then concat(' ', {iso}, ' ')
        when 10 then '999' else 'soon' end""")
    parsed = P.parse_datetime("sent")
    df = e.select("event_id", "ts", text.alias("sent")).withColumn("parsed", parsed)
    reference = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return df.select(
        "event_id", "sent", "parsed", FD.days_between("parsed", reference).alias("days_off"),
        FD.iso_weekday("parsed").alias("weekday"),
        SC.clamp01((F.col("event_id") % 40).cast("double") / 20 - 0.5).alias("clamped"))


# ---- feature groups --------------------------------------------------------------------
def _columns(df: DataFrame, text: str) -> DataFrame:
    return df.select("transaction_id", *text.split())


def features_time(b: Bank) -> DataFrame:
    return _columns(FE.features_time(b.transactions),
                    "transaction_hour transaction_day_of_week is_weekend is_night_transaction")


def features_amount(b: Bank) -> DataFrame:
    return _columns(FE.features_amount(b.still), "amount_to_balance_ratio amount_to_available_ratio "
                    "amount_change is_high_value balance_utilization below_minimum_balance")


def features_location(b: Bank) -> DataFrame:
    return _columns(FE.features_location(b.still), "is_home_city is_home_country location_mismatch")


def features_account(b: Bank) -> DataFrame:
    return _columns(FE.features_account(b.still), "account_age_days is_new_account "
                    "days_since_last_activity is_dormant_account is_active_account is_active_customer")


def features_customer(b: Bank) -> DataFrame:
    return _columns(FE.features_customer(b.still, A.AS_OF),
                    "customer_age_days customer_tenure_days is_new_customer")


def features_type_channel(b: Bank) -> DataFrame:
    return _columns(FE.features_type_channel(b.transactions), "is_deposit is_purchase is_withdrawal "
                    "is_transfer is_atm is_online is_mobile is_branch")


def features_risk(b: Bank) -> DataFrame:
    return _columns(FE.features(b.still, A.AS_OF),
                    "risk_score_base segment_risk_adjustment combined_risk_score")


def features_velocity(b: Bank) -> DataFrame:
    return _columns(FE.features_velocity(b.moving), "is_high_velocity is_unusual_amount")


def features_all(b: Bank) -> DataFrame:
    return b.featured


def feature_matrix(b: Bank) -> DataFrame:
    return FE.feature_matrix(b.featured)


# ---- scoring and training --------------------------------------------------------------
_SCORES = ["fraud_score", "is_fraud_predicted", "confidence_score", "fraud_type",
           "risk_indication", "action_taken"]


def score_defaults(b: Bank) -> DataFrame:
    return SC.score_defaults(b.transactions).select("transaction_id", *_SCORES)


def risk_bands(b: Bank) -> DataFrame:
    return b.scored_runs.select("transaction_id", "run", "fraud_score", "confidence_score",
                                "risk_indication", "action_taken")


def fraud_type(b: Bank) -> DataFrame:
    return b.scored_runs.select("transaction_id", "run", "is_fraud_predicted", "fraud_type")


def _matrix(b: Bank) -> DataFrame:
    return FE.feature_matrix(b.featured)


def train_iforest_nodes(b: Bank) -> DataFrame:
    sample = sample_rows(_matrix(b), "transaction_id", 200, 256, 42)
    return grow_trees(sample, FE.ML_FEATURES, 256, 42)


def _iforest(b: Bank):
    key = ("iforest", id(b.spark), b.sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = train_iforest(_matrix(b).persist(), FE.ML_FEATURES)
    return _TRAINED[key]


def score_iforest_query(b: Bank) -> DataFrame:
    return TR.score(b.featured, _iforest(b)).select("transaction_id", *_SCORES)


def anomaly_summary(b: Bank) -> DataFrame:
    return M.anomaly_summary(score_iforest(_matrix(b), _iforest(b)))


# A small forest with stated nodes (tree, node, feature, cut, left, right, size, depth), so that
# scoring can be checked without training.
FIXED_FEATURES = ["amount", "combined_risk_score", "transactions_last_24h"]
FIXED_NODES = [
    (0, 0, 0, 200.0, 1, 2, 16, 0), (0, 1, -1, 0.0, -1, -1, 12, 1), (0, 2, 1, 6.0, 3, 4, 4, 1),
    (0, 3, -1, 0.0, -1, -1, 3, 2), (0, 4, -1, 0.0, -1, -1, 1, 2),
    (1, 0, 2, 5.0, 1, 2, 16, 0), (1, 1, -1, 0.0, -1, -1, 10, 1), (1, 2, -1, 0.0, -1, -1, 6, 1),
]


def _fixed_scores(b: Bank) -> DataFrame:
    nodes = pd.DataFrame(FIXED_NODES, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])
    return score_iforest(_matrix(b), IsolationForest(nodes, FIXED_FEATURES, 2, 16, -0.5))


def score_fixed_iforest(b: Bank) -> DataFrame:
    return _fixed_scores(b).select("transaction_id", F.round("raw_score", 6).alias("raw_score"), "is_outlier")


def anomaly_summary_fixed(b: Bank) -> DataFrame:
    return M.anomaly_summary(_fixed_scores(b))


# Stated splits (tree, node, feature, cut, left, right) over the same features; what the nodes hold
# is counted on the labelled rows.
FIXED_SPLITS = [
    (0, 0, 1, 4.0, 1, 2), (0, 1, 0, 150.0, 3, 4), (0, 2, -1, 0.0, -1, -1), (0, 3, -1, 0.0, -1, -1), (0, 4, -1, 0.0, -1, -1),
    (1, 0, 2, 3.0, 1, 2), (1, 1, -1, 0.0, -1, -1), (1, 2, 0, 400.0, 3, 4), (1, 3, -1, 0.0, -1, -1), (1, 4, -1, 0.0, -1, -1),
]


def _fixed_forest(b: Bank) -> TreeForest:
    key = ("fixed forest", id(b.spark), b.sf_dir)
    if key not in _TRAINED:
        shape = pd.DataFrame(FIXED_SPLITS, columns=[c.split()[0] for c in SHAPE_SCHEMA.split(", ")])
        _TRAINED[key] = fit_nodes(training_labelled(b), shape, FIXED_FEATURES)
    return _TRAINED[key]


def score_fixed_forest(b: Bank) -> DataFrame:
    scored = TR.score(b.featured, _fixed_forest(b))
    return scored.select("transaction_id", *_SCORES)


def top_features_fixed(b: Bank) -> DataFrame:
    top = TR.top_features(_fixed_forest(b).importances(b.spark))
    return top.select("feature", F.round("importance", 6).alias("importance"))


def _forest(b: Bank):
    key = ("forest", id(b.spark), b.sf_dir)
    if key not in _TRAINED:
        rows = training_labelled(b).persist()
        train, test = TR.split_stratified(rows)
        _TRAINED[key] = (TR.train_forest(train), test)
    return _TRAINED[key]


def train_forest_metrics(b: Bank) -> DataFrame:
    model, test = _forest(b)
    scored = TR.with_probability(test, model).withColumn(
        "prediction", (F.col("raw_score") >= SC.DEFAULT_THRESHOLD).cast("int"))
    return M.classification_report(scored)


def score_forest(b: Bank) -> DataFrame:
    return TR.score(b.featured, _forest(b)[0]).select("transaction_id", *_SCORES)


def top_features(b: Bank) -> DataFrame:
    return TR.top_features(TR.feature_importances(b.spark, _forest(b)[0]))


# ---- quality ---------------------------------------------------------------------------
def dq_not_null(b: Bank) -> DataFrame:
    return Q.not_null(b.stg("transaction"), "amount").select("transaction_id", "account_number")


def dq_unique(b: Bank) -> DataFrame:
    return Q.unique(b.raw("transaction"), "TransactionID")


def dq_accepted_values(b: Bank) -> DataFrame:
    return Q.accepted_values(b.stg("transaction"), "channel", ("ATM", "Online", "Mobile", "Branch"))


def dq_relationships(b: Bank) -> DataFrame:
    return Q.relationships(b.stg("transaction"), "merchant_id", b.stg("merchant"), "merchant_id")


def dq_report(b: Bank) -> DataFrame:
    """All declared tests. The facts are stored first, as several tests read them, and so are the rows that
    both facts consist of; with the columns that are tested, as others would be carried through every join
    for nobody."""
    models = {f"stg_{n}": b.stg(n) for n in BATCH_MODELS}
    models |= {f"dim_{n}": df for n, df in b.dims.items()} | {"dim_fraud_model": b.model}
    models |= {"stg_realtime_transaction": b.stg_realtime, "stg_realtime_fraud_detection": b.stg_detection}
    models |= {"fact_loan_snapshot": b.fact_loan(A.AS_OF), "fact_account_balance_snapshot": b.fact_balance}
    links = tuple(on for _, on, _, _ in FT.LINKS)
    chosen, others = FT.only_columns(FT.one_row_each(b.sources), ("transaction_id", "amount", *links))
    rows = cut_lineage(chosen).withColumns(others)
    both = FT.fact_transaction(rows, b.dims, b.now, keys=("customer_key", "account_key"), chosen=True)
    facts = {"fact_transaction": FT.fact_transaction(rows, b.dims, b.now, chosen=True),
             "fact_fraud_detection": FT.fact_fraud_detection(b.stg_detection, both, b.model, b.now)}
    models |= {n: cut_lineage(df.select(*tested_columns(n))) for n, df in facts.items()}
    return Q.dq_report(warehouse_checks({n: df for n, df in models.items() if n in MODEL_TESTS}))


# ---- facts -----------------------------------------------------------------------------
def fact_transaction_usd(b: Bank) -> DataFrame:
    return FT.with_usd(b.fact_with(), A.rates(b.spark, b.sf_dir), ["amount"],
                       "transaction_timestamp").select("transaction_id", "currency", "amount", "amount_usd")


def _loans(b: Bank) -> DataFrame:
    return b.fact_loan("2024-01-31").unionByName(b.fact_loan(A.AS_OF))


QUERIES = {
    "load_raw_transaction": load_raw_transaction,
    "load_summary": load_summary,
    "load_totals": load_totals,
    "merge_keeps_labels": merge_keeps_labels,
    "refresh_twice": refresh_twice,
    "scd2_three_loads": scd2_three_loads,
    "labelled_transactions": lambda b: R.labels(b.labelled_with()),
    "detections_split": detections_split,
    "etl_metadata": etl_metadata,
    "merge_upsert": merge_upsert,
    "register_model": register_model,
    "cdc_filter": lambda b: C.count_ops(b.parsed),
    "cdc_parse": cdc_parse,
    "incremental_since": incremental_since,
    **{f"stg_{n}": (lambda b, n=n: b.stg(n)) for n in BATCH_MODELS},
    "stg_realtime_transaction": lambda b: b.stg_realtime,
    "stg_realtime_fraud_detection": lambda b: b.stg_detection,
    "enrich_account": enrich_account,
    "enrich_customer": enrich_customer,
    "two_tier_lookup": two_tier_lookup,
    "training_base": training_base,
    "scd2_changes": scd2_changes,
    "point_in_time_join": point_in_time_join,
    "training_labelled": training_labelled,
    "account_activity": lambda b: FT.account_activity(b.stg("transaction")),
    "label_count": lambda b: M.label_count(R.labels(b.labelled_with())),
    "velocity_quality": velocity_quality,
    "class_balance": lambda b: M.class_balance(R.labels(b.labelled_with())),
    "anomaly_summary": anomaly_summary,
    "score_fixed_iforest": score_fixed_iforest,
    "anomaly_summary_fixed": anomaly_summary_fixed,
    "score_fixed_forest": score_fixed_forest,
    "top_features_fixed": top_features_fixed,
    "classification_report": lambda b: M.classification_report(_judged(b)),
    "auc_roc": lambda b: M.auc_roc(_judged(b)),
    "dimension_health": dimension_health,
    "dedup_latest": dedup_latest,
    "dedup_priority": dedup_priority,
    "dedup_latest_detection": dedup_latest_detection,
    "velocity_1h_24h": velocity_1h_24h,
    "velocity_microbatches": velocity_microbatches,
    "velocity_defaults": velocity_defaults,
    "scd2_history": scd2_history,
    "scd2_apply": scd2_apply,
    "top_features": top_features,
    "union_sources": union_sources,
    "scalar_suite": scalar_suite,
    "parse_datetime_suite": parse_datetime_suite,
    "features_time": features_time,
    "features_amount": features_amount,
    "features_location": features_location,
    "features_account": features_account,
    "features_customer": features_customer,
    "features_type_channel": features_type_channel,
    "features_risk": features_risk,
    "features_velocity": features_velocity,
    "features_all": features_all,
    "feature_matrix": feature_matrix,
    "score_defaults": score_defaults,
    "score_iforest": score_iforest_query,
    "score_forest": score_forest,
    "risk_bands": risk_bands,
    "fraud_type": fraud_type,
    "train_forest_metrics": train_forest_metrics,
    "train_iforest_nodes": train_iforest_nodes,
    **{f"dim_{n}": (lambda b, n=n: _no_audit(b.dims[n]))
       for n in ("branch", "department", "employee", "transaction_type", "merchant", "atm",
                 "customer", "account", "card")},
    "dim_fraud_model": lambda b: b.model.select("model_key", "model_name", "model_version", "is_active"),
    "dim_date": lambda b: b.dates,
    "fact_transaction": lambda b: _no_audit(b.fact_transaction),
    "fact_fraud_detection": lambda b: _no_audit(b.fact_detection),
    "fact_account_balance_snapshot": lambda b: _no_audit(b.fact_balance),
    "fact_loan_snapshot": lambda b: _no_audit(b.fact_loan(A.AS_OF)),
    "fact_fraud_alert": lambda b: _no_audit(b.alerts),
    "label_writeback": lambda b: b.labelled_with().select(
        "transaction_id", "is_fraud_confirmed", "fraud_label_date_key", "fraud_label_source"),
    "fact_transaction_usd": fact_transaction_usd,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_report": dq_report,
    "model_precision_recall": lambda b: Z.model_precision_recall(b.fact_detection, b.alerts, b.model),
    "fpr_by_merchant_category": lambda b: Z.fpr_by_merchant_category(
        b.alerts, b.fact_with("merchant_key"), b.dims["merchant"]),
    "customer_risk_trend": lambda b: Z.customer_risk_trend(
        b.fact_detection, b.dims["customer"], b.dates, "week"),
    "alert_sla": lambda b: Z.alert_sla(b.alerts, b.dims["employee"], b.dates),
    "volume_by_channel_country": lambda b: Z.volume_by_channel_country(
        b.fact_with("account_key"), b.dates, b.dims["account"]),
    "loan_portfolio_monthly": lambda b: Z.loan_portfolio_monthly(
        _loans(b), b.dims["customer"], b.dates),
    "balance_anomalies": lambda b: Z.balance_anomalies(b.daily_balance, b.dims["account"], b.dates),
    "fraud_hotspots": lambda b: Z.fraud_hotspots(
        b.labelled_with("atm_key", "merchant_key"), b.dims["atm"], b.dims["merchant"]),
    "score_drift": lambda b: Z.score_drift(b.fact_detection, b.model, b.dates, period="week"),
    "label_rate_by_analyst": lambda b: Z.label_rate_by_analyst(
        b.alerts, b.dims["employee"], b.dates),
}
