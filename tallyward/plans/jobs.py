"""The four jobs as plain functions; any scheduler may call them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.ml.forest import load_forest
from tallyward.ml.iforest import IsolationForest, train_iforest
from tallyward.ml.metrics import auc_roc, classification_report, label_count
from tallyward.ml.training import (
    MIN_LABELS, choose_mode, labelled_matrix, registry_row, split_stratified, train_forest,
    training_base, with_probability,
)
from tallyward.operators.enrich import live_accounts, live_customers, live_transactions
from tallyward.operators.features import ML_FEATURES, feature_matrix, features
from tallyward.operators.dedup import latest_per_key
from tallyward.operators.quality import dq_report
from tallyward.operators.scd2 import scd2_apply
from tallyward.operators.scoring import DEFAULT_THRESHOLD, ModelId
from tallyward.operators.velocity import velocity
from tallyward.plans import facts as FT
from tallyward.plans import staging as ST
from tallyward.plans.dims import dim_fraud_model
from tallyward.plans.warehouse import TYPE2, dimensions, warehouse_checks
from tallyward.schemas import BATCH_COLUMNS, RAW_LOCATIONS, RAW_SCHEMAS
from tallyward.sources.ledger import Pending, pending, record
from tallyward.sources.manifest import build, read_table, snapshot, vacuum
from tallyward.sources.raw import Reader, extract_all, labels, load_raw
from tallyward.sources.sinks import _exists, current_path, merge_upsert, overwrite, publish, register_model

_TYPE2_KEYS = {"employee": "employee_id", "customer": "customer_id", "account": "account_number"}


# Facts are merged: tables with a manifest. Key, partition and the order of a row's versions.
FACTS = {
    "fact_transaction": ("transaction_id", "date_key", FT.VERSION),
    "fact_fraud_detection": ("transaction_id", "detection_date_key", (("detection_timestamp", "desc"),)),
    "fact_account_balance_snapshot": ("snapshot_key", "snapshot_date_key", ()),
    "fact_loan_snapshot": ("snapshot_key", "snapshot_date_key", ()),
}


@dataclass
class Warehouse:
    """Folders of one warehouse below ``root``."""

    spark: SparkSession
    root: str
    as_of: str
    now: str
    batch_id: str = ""
    reader: Reader | None = None
    model_id: ModelId = field(default_factory=ModelId)

    def base(self, name: str) -> str:
        return f"{self.root}/dwh/{name}"

    def path(self, name: str) -> str:
        """Where the table's current version lies."""
        return current_path(self.spark, self.base(name))

    def has(self, name: str) -> bool:
        if name in FACTS:
            return snapshot(self.spark, self.base(name)) is not None
        return _exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base(name)) if name in FACTS else self.spark.read.parquet(self.path(name))

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        overwrite(df, self.path(name))
        return self.read(name)

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        publish(df, self.base(name))
        return self.read(name)

    def raw_path(self, table: str) -> str:
        return f"{self.root}/batch/raw/{table}/batch_{self.batch_id}"

    def raw(self, table: str) -> DataFrame:
        return load_raw(self.spark, self.raw_path(table), RAW_SCHEMAS[table])


def _stage_all(w: Warehouse) -> dict[str, DataFrame]:
    """Stage and store every batch model, so each is parsed and deduplicated once."""
    staged = {}
    for name in BATCH_COLUMNS:
        staged[name] = w.keep(f"stg_{name}", ST.stage_batch(name, w.raw(name), w.batch_id, w.as_of))
    return staged


def _apply_versions(w: Warehouse, name: str, fresh: DataFrame) -> DataFrame:
    """Type-2 table after this load: history kept, changed rows closed and reopened.

    Non-tracked columns of an unchanged version stay as they were when it opened.
    """
    path = f"dim_{name}"
    if not w.has(path):
        return w.publish(path, fresh)
    after = scd2_apply(w.read(path), fresh.drop("effective_date", "expiry_date", "is_current"),
                       _TYPE2_KEYS[name], w.as_of)
    return w.publish(path, after)


def _build_dimensions(w: Warehouse, staged: dict[str, DataFrame], rebuild: bool) -> dict[str, DataFrame]:
    def keep(name: str, df: DataFrame) -> DataFrame:
        short = name.removeprefix("dim_")
        if short in TYPE2:
            return w.publish(name, df) if rebuild else _apply_versions(w, short, df)
        return w.keep(name, df)

    return dimensions(lambda n: staged[n], w.as_of, w.now, keep=keep)


def _realtime(w: Warehouse, name: str) -> DataFrame:
    folder = f"{w.root}/{RAW_LOCATIONS[name]}"
    if not _exists(w.spark, folder):
        return w.spark.createDataFrame([], RAW_SCHEMAS[name])
    return load_raw(w.spark, folder, RAW_SCHEMAS[name])


def _new_realtime(w: Warehouse, rows: DataFrame, fact: str, full_refresh: bool) -> Pending:
    """Of stored stream rows, those in files that neither refresh has merged into ``fact`` yet, unless
    all are wanted. What comes meanwhile, however old its rows, is merged next time."""
    if "dt" not in rows.columns:  # no stream has written yet
        return Pending(rows, w.spark.createDataFrame([], "file string, dt date"))
    found = pending(rows, w.base(f"merged_files_{fact}"))
    return Pending(rows, found.files) if full_refresh else found


def _remember(w: Warehouse, found: Pending, fact: str) -> None:
    record(found, w.base(f"merged_files_{fact}"))


def _merge(w: Warehouse, name: str, df: DataFrame, full_refresh: bool = False) -> None:
    key, partition, version = FACTS[name]
    build(df, w.base(name), key, partition, full_refresh, FT.LABELS if name == "fact_transaction" else (), version)


def write_back(w: Warehouse, decisions: DataFrame, source: str = "ANALYST") -> None:
    """Analysts' decisions as labels of stored transactions; rows without one are left alone."""
    rows = w.read("fact_transaction")
    _merge(w, "fact_transaction", FT.label_writeback(rows, decisions, w.as_of, source, decided_only=True))


def _build_facts(w: Warehouse, staged, dims, full_refresh: bool) -> dict[str, DataFrame]:
    # Detections are listed first: the stream writes them after their transactions.
    detections = _realtime(w, "realtime_fraud_detection")
    transactions = _realtime(w, "realtime_transaction")
    moved = _new_realtime(w, transactions, "fact_transaction", full_refresh)
    found = _new_realtime(w, detections, "fact_fraud_detection", full_refresh)
    stream = ST.stage_realtime_transaction(moved.rows)
    fresh = ST.stage_realtime_detection(found.rows)
    registry = w.read("model_registry") if w.has("model_registry") else None
    model = w.publish("dim_fraud_model", dim_fraud_model(ST.stage_realtime_detection(detections), registry, w.now))
    sources = FT.union_sources(
        FT.realtime_source(stream), FT.batch_source(staged["transaction"], staged["account"]))
    _merge(w, "fact_transaction", FT.fact_transaction(sources, dims, w.now, versioned=True), full_refresh)
    _merge(w, "fact_fraud_detection", FT.fact_fraud_detection(fresh, w.read("fact_transaction"), model, w.now), full_refresh)
    _remember(w, moved, "fact_transaction")
    _remember(w, found, "fact_fraud_detection")
    snapshots = {
        "fact_account_balance_snapshot": FT.fact_account_balance_snapshot(
            staged["account"], staged["transaction"], dims["customer"], dims["account"], w.as_of, w.now),
        "fact_loan_snapshot": FT.fact_loan_snapshot(
            staged["loan"], dims["customer"], dims["branch"], w.as_of, w.now),
    }
    for name, df in snapshots.items():
        _merge(w, name, df, full_refresh)
    names = ("fact_transaction", "fact_fraud_detection", *snapshots)
    return {**{n: w.read(n) for n in names}, "dim_fraud_model": model}


def _batch_job(w: Warehouse, full_refresh: bool) -> dict[str, DataFrame]:
    loads = extract_all(w.spark, w.reader, f"{w.root}/batch/raw", w.batch_id, w.now)
    failed = [r["table"]
              for r in loads.filter("status = 'FAILED'").collect()]  # at most a dozen rows
    if failed:
        raise RuntimeError(f"extract failed for {', '.join(failed)}")
    staged = _stage_all(w)
    dims = _build_dimensions(w, staged, rebuild=full_refresh)
    facts = _build_facts(w, staged, dims, full_refresh)
    models = {f"stg_{n}": df for n, df in staged.items()}
    models |= {f"dim_{n}": df for n, df in dims.items()}
    models |= facts
    report = dq_report(warehouse_checks(models))
    return {"loads": loads, "report": report, **models}


def initial_load(w: Warehouse) -> dict[str, DataFrame]:
    """Extract everything and rebuild all tables."""
    return _batch_job(w, full_refresh=True)


def batch_refresh(w: Warehouse) -> dict[str, DataFrame]:
    """Extract one batch and merge it: Type-2 history is kept and facts are merged on their keys."""
    return _batch_job(w, full_refresh=False)


def realtime_refresh(w: Warehouse) -> dict[str, DataFrame]:
    """Merge the stream files that no refresh has merged yet into the two stream-fed facts."""
    dims = {n: w.read(f"dim_{n}") for n in
            ("customer", "account", "transaction_type", "merchant", "atm", "card")}
    detections = _realtime(w, "realtime_fraud_detection")  # listed first, as in a batch
    moved = _new_realtime(w, _realtime(w, "realtime_transaction"), "fact_transaction", False)
    if not moved.is_empty():
        staged = ST.stage_realtime_transaction(with_source_columns(moved.rows))
        _merge(w, "fact_transaction", FT.fact_transaction(FT.realtime_source(staged), dims, w.now, versioned=True))
        _remember(w, moved, "fact_transaction")
    found = _new_realtime(w, detections, "fact_fraud_detection", False)
    if not found.is_empty():
        staged = ST.stage_realtime_detection(with_source_columns(found.rows))
        registry = w.read("model_registry") if w.has("model_registry") else None
        model = dim_fraud_model(staged, registry, w.now)
        if w.has("dim_fraud_model"):  # the models of these files, merged into those known
            model = merge_upsert(w.read("dim_fraud_model"), model, "model_key")
        model = w.publish("dim_fraud_model", model)
        _merge(w, "fact_fraud_detection", FT.fact_fraud_detection(staged, w.read("fact_transaction"), model, w.now))
        _remember(w, found, "fact_fraud_detection")
    models = {n: w.read(n) for n in ("fact_transaction", "fact_fraud_detection", "dim_fraud_model")
              if w.has(n)}
    return {"report": dq_report(warehouse_checks(models)), **models}


def tidy(w: Warehouse) -> None:
    """Drop what old versions of the facts consist of. No other job may run meanwhile."""
    for name in FACTS:
        if w.has(name):
            vacuum(w.spark, w.base(name))


def with_source_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_SOURCE_FILE", F.coalesce("_SOURCE_FILE", F.lit("stream")))


def training_matrix(w: Warehouse) -> DataFrame:
    """The 39 model inputs of all stored batch transactions."""
    txn = latest_per_key(live_transactions(w.raw("transaction")).filter("transaction_id <> ''"),
                         "transaction_id", [F.col("transaction_date").desc_nulls_last()])
    base = training_base(velocity(txn), live_accounts(w.raw("account")), live_customers(w.raw("customer")))
    return feature_matrix(features(base, w.as_of))


def retrain(w: Warehouse, mode: str = "auto", min_labels: int = MIN_LABELS, trees: int | None = None,
            threshold: float = DEFAULT_THRESHOLD, seed: int = 42):
    """Train, save and register a model. Returns (mode used, model, metrics).

    ``auto`` is supervised once there are enough labels, and falls back to unsupervised where
    too few of them match a transaction.
    """
    spark = w.spark
    matrix = w.keep("training_matrix", training_matrix(w))
    labelled = labelled_matrix(matrix, labels(w.read("fact_transaction")))
    if mode == "auto":
        known = label_count(labels(w.read("fact_transaction"))).first()[0]
        mode = choose_mode(known, min_labels)
        if mode == "supervised":
            mode = choose_mode(labelled.count(), min_labels)
    target = f"{w.root}/models/{w.model_id.name}/{w.model_id.version}"
    if mode == "supervised":
        train, test = split_stratified(w.keep("training_labelled", labelled), seed=seed)
        model = train_forest(train, trees=trees or 300, seed=seed)
        scored = with_probability(test, model).withColumn(
            "prediction", (F.col("raw_score") >= threshold).cast("int"))
        scored = w.keep("training_scored", scored.select("label", "raw_score", "prediction"))
        report = {r["label"]: r for r in classification_report(scored).collect()}  # one per class
        fraud = report.get(1)
        metrics = {"auc_roc": auc_roc(scored, "raw_score").first()["auc_roc"]}
        if fraud:
            metrics |= {f"{m}_score": fraud[m if m != "f1" else "f1_score"]
                        for m in ("precision", "recall", "f1")}
        model.save(spark, f"{target}/compiled")
        algorithm, n = "RandomForestClassifier", train.count()
    else:
        model = train_iforest(matrix, ML_FEATURES, trees=trees or 200, seed=seed)
        model.save(spark, target)
        metrics, algorithm, n = {}, "IsolationForest", matrix.count()
    row = registry_row(spark, w.model_id.name, w.model_id.version, algorithm, w.as_of, threshold, n, metrics)
    if w.has("model_registry"):
        others = w.read("model_registry").filter(
            ~((F.col("model_name") == w.model_id.name) & (F.col("model_version") == w.model_id.version)))
        w.publish("model_registry", register_model(others, row))
    else:
        w.publish("model_registry", row)
    return mode, model, metrics


def saved_model(w: Warehouse):
    """The model of ``w.model_id`` as ``retrain()`` saved it, for ``score()`` and the stream; None where
    there is none. A supervised forest comes as its node table; one that an older version saved as a pipeline
    alone comes as that."""
    if not w.has("model_registry"):
        return None
    own = (F.col("model_name") == w.model_id.name) & (F.col("model_version") == w.model_id.version)
    entry = w.read("model_registry").filter(own).select("algorithm").first()
    if entry is None:
        return None
    target = f"{w.root}/models/{w.model_id.name}/{w.model_id.version}"
    if entry["algorithm"] == "IsolationForest":
        return IsolationForest.load(w.spark, target)
    if _exists(w.spark, f"{target}/compiled/features/_SUCCESS"):
        return load_forest(w.spark, f"{target}/compiled")
    return PipelineModel.load(target)


def staging_views(w: Warehouse, prefix: str = "stg_") -> list[str]:
    """Temporary views of all staged batch tables that are there, so that SQL can be run over them.
    Views are plans: nothing is read before a query asks. Returns their names."""
    names = []
    for name in BATCH_COLUMNS:
        if _exists(w.spark, w.raw_path(name)):
            staged = ST.stage_batch(name, w.raw(name), w.batch_id, w.as_of)
            staged.createOrReplaceTempView(f"{prefix}{name}")
            names.append(f"{prefix}{name}")
    return names
