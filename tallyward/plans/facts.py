"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import month_boundaries
from tallyward.functions.keys import date_key, or_unknown, surrogate_key
from tallyward.operators.dedup import by_priority, latest_per_key
from tallyward.operators.scoring import REVIEW_FROM
from tallyward.plans.dims import current
from tallyward.sources.sinks import with_audit

# Night hours of the batch rows; stream rows bring their own flag.
BATCH_NIGHT = (22, 6)

_SHARED = """transaction_id account_number customer_id merchant_id atm_id card_number_hashed
    transaction_date amount currency transaction_type_id transaction_method channel city state
    country latitude longitude is_international transaction_hour is_night_transaction load_ts
    source_priority""".split()


def realtime_source(stg_realtime: DataFrame) -> DataFrame:
    return stg_realtime.withColumns({
        "load_ts": F.col("processing_timestamp"), "source_priority": F.lit(1),
    }).select(*_SHARED)


def batch_source(stg_transaction: DataFrame, stg_account: DataFrame,
                 night: tuple[int, int] = BATCH_NIGHT) -> DataFrame:
    owner = stg_account.select("account_number", "customer_id")
    hour = F.hour("transaction_date")
    at_night = F.coalesce((hour >= night[0]) | (hour < night[1]), F.lit(False))
    return stg_transaction.join(owner, "account_number", "left").withColumns({
        "transaction_hour": hour, "is_night_transaction": at_night,
        "load_ts": F.col("transaction_date"), "source_priority": F.lit(2),
    }).select(*_SHARED)


def union_sources(realtime: DataFrame, batch: DataFrame) -> DataFrame:
    return realtime.unionByName(batch)


# Each dimension a transaction refers to: its join column, the keys it gives, whether it has versions.
LINKS = (
    ("customer", "customer_id", ("customer_key",), True),
    ("account", "account_number", ("account_key", "branch_key"), True),
    ("transaction_type", "transaction_type_id", ("transaction_type_key",), False),
    ("merchant", "merchant_id", ("merchant_key",), False),
    ("atm", "atm_id", ("atm_key",), False),
    ("card", "card_number_hashed", ("card_key",), False),
)
FACT_KEYS = tuple(k for _, _, keys, _ in LINKS for k in keys)


def star_join(df: DataFrame, dims: dict[str, DataFrame], keys: tuple[str, ...] = FACT_KEYS) -> DataFrame:
    """Resolve ``keys``, by default all of the six dimensions and the account's branch; a miss is the
    unknown member. Dimensions none of whose keys are asked for are not joined: Spark can't know that
    their keys are unique, so it would keep a left join that nobody reads.

    Dimension sides carry only the join column and the key. None is forced to broadcast;
    hot and NULL keys of shuffled joins are split by AQE.
    """
    for name, on, given, versioned in LINKS:
        wanted = [k for k in given if k in keys]
        if wanted:
            dim = current(dims[name]) if versioned else dims[name]
            df = df.join(dim.select(on, *wanted), on, "left")
    return df.withColumns({k: or_unknown(k) for k in keys})


# Which of two rows of a transaction is the newer one: the rule of by_priority(), for merges.
VERSION = (("source_priority", "asc"), ("source_load_ts", "desc"))


def one_row_each(sources: DataFrame) -> DataFrame:
    """One row per transaction; real-time rows win over batch rows."""
    return by_priority(sources, "transaction_id", "source_priority", "load_ts")


def only_columns(sources: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, dict[str, Column]]:
    """Source rows with ``columns`` alone, to be stored, and the others as NULL, to be put back."""
    others = {f.name: F.lit(None).cast(f.dataType) for f in sources.schema if f.name not in columns}
    return sources.select(*columns), others


def fact_transaction(sources: DataFrame, dims: dict[str, DataFrame], now: str, versioned: bool = False,
                     keys: tuple[str, ...] = FACT_KEYS, chosen: bool = False) -> DataFrame:
    """One row per transaction; real-time rows win over batch rows, unless ``sources`` come ``chosen`` by
    one_row_each(). ``versioned`` adds the columns that tell a merge how new a row is. A reader of a few
    dimensions names their ``keys``; the other key columns are then left out."""
    order = ("customer_key", "account_key", "card_key", "merchant_key", "atm_key", "branch_key", "transaction_type_key")
    version = ["source_priority", F.col("load_ts").alias("source_load_ts")] if versioned else []
    rows = star_join(sources if chosen else one_row_each(sources), dims, keys)
    return with_audit(rows.select(
        surrogate_key("transaction_id").alias("transaction_fact_key"), "transaction_id",
        date_key("transaction_date").alias("date_key"), *[k for k in order if k in keys], "amount",
        "currency", "transaction_method", "channel", "city", "state", "country", "latitude",
        "longitude", F.col("transaction_hour").alias("hour_of_day"), "is_night_transaction",
        F.col("is_international").alias("is_cross_border"),
        F.lit(None).cast("boolean").alias("is_fraud_confirmed"),
        F.lit(None).cast("int").alias("fraud_label_date_key"),
        F.lit(None).cast("string").alias("fraud_label_source"),
        F.col("transaction_date").alias("transaction_timestamp"), *version), now)


# Columns that only analysts fill; merges keep them.
LABELS = ("is_fraud_confirmed", "fraud_label_date_key", "fraud_label_source")


def one_decision(decisions: DataFrame) -> DataFrame:
    """The last decision of each transaction: a decided one before an open one, the longest review first."""
    return latest_per_key(decisions, "transaction_id", [
        F.col("is_confirmed_fraud").isNull(), F.col("resolution_minutes").desc_nulls_last()])


def latest_detection(stg_detection: DataFrame, key=("transaction_id",)) -> DataFrame:
    return latest_per_key(stg_detection, list(key),
                          [F.col("processing_timestamp").desc_nulls_last()])


def fact_fraud_detection(stg_detection: DataFrame, fact_txn: DataFrame, model: DataFrame,
                         now: str, key=("transaction_id",)) -> DataFrame:
    """Latest inference per ``key`` (add the model columns to keep one row per model)."""
    det = latest_detection(stg_detection, key)
    links = fact_txn.select("transaction_id", "transaction_fact_key", "customer_key", "account_key")
    models = model.select("model_name", "model_version", "model_key")
    df = det.join(links, "transaction_id", "left").join(
        models, ["model_name", "model_version"], "left")
    return with_audit(df.select(
        "transaction_id", F.lit(None).cast("string").alias("result_id"),
        or_unknown("transaction_fact_key").alias("transaction_fact_key"),
        date_key("processing_timestamp").alias("detection_date_key"),
        or_unknown("customer_key").alias("customer_key"),
        or_unknown("account_key").alias("account_key"),
        or_unknown("model_key").alias("model_key"),
        "fraud_score", "is_fraud_predicted", "confidence_score", "fraud_type",
        "risk_indication", "action_taken", "is_review_required", "inference_latency_ms",
        F.col("processing_timestamp").alias("detection_timestamp")), now)


def account_activity(stg_transaction: DataFrame, day: str | None = None) -> DataFrame:
    """Count, credits and debits per account, of the whole load or of one day."""
    rows = stg_transaction
    if day is not None:
        rows = rows.filter(F.to_date("transaction_date") == F.lit(day).cast("date"))
    zero = F.lit(0).cast("decimal(18,2)")
    return rows.groupBy("account_number").agg(
        F.count("*").alias("txn_count"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount")).otherwise(zero)).alias("total_credits"),
        F.sum(F.when(F.col("amount") < 0, -F.col("amount")).otherwise(zero)).alias("total_debits"),
    )


def fact_account_balance_snapshot(stg_account: DataFrame, stg_transaction: DataFrame,
                                  customer: DataFrame, account: DataFrame, as_of: str, now: str,
                                  activity: str = "batch") -> DataFrame:
    """One row per account and day. ``activity="day"`` counts only the day's transactions."""
    day = F.lit(as_of).cast("date")
    moves = account_activity(stg_transaction, as_of if activity == "day" else None)
    df = (
        stg_account
        .join(current(customer).select("customer_id", "customer_key"), "customer_id", "left")
        .join(current(account).select("account_number", "account_key"), "account_number", "left")
        .join(moves, "account_number", "left")
    )
    zero = F.lit(0).cast("decimal(18,2)")
    return with_audit(df.select(
        surrogate_key("account_number", day).alias("snapshot_key"),
        or_unknown("account_key").alias("account_key"),
        or_unknown("customer_key").alias("customer_key"),
        date_key(day).alias("snapshot_date_key"), "balance", "available_balance", "currency",
        F.coalesce("total_debits", zero).cast("decimal(18,2)").alias("daily_debit_total"),
        F.coalesce("total_credits", zero).cast("decimal(18,2)").alias("daily_credit_total"),
        F.coalesce("txn_count", F.lit(0)).alias("transaction_count")), now)


def fact_loan_snapshot(stg_loan: DataFrame, customer: DataFrame, branch: DataFrame, as_of: str,
                       now: str) -> DataFrame:
    """One row per loan and run date."""
    day = F.lit(as_of).cast("date")
    df = (
        stg_loan
        .join(current(customer).select("customer_id", "customer_key"), "customer_id", "left")
        .join(branch.select("branch_id", "branch_key"), "branch_id", "left")
    )
    both = F.col("end_date").isNotNull() & F.col("start_date").isNotNull()
    left = F.when(both, F.greatest(F.lit(0), month_boundaries(day, "end_date")))
    return with_audit(df.select(
        surrogate_key("loan_id", day).alias("snapshot_key"), "loan_id",
        or_unknown("customer_key").alias("customer_key"),
        or_unknown("branch_key").alias("branch_key"),
        date_key(day).alias("snapshot_date_key"),
        *[date_key(c, None).alias(f"{c}_key") for c in ("start_date", "end_date", "next_payment_date")],
        "loan_type", "account_number", "loan_amount", "outstanding_amount", "interest_rate",
        "loan_term_months", left.alias("remaining_months"), "monthly_payment",
        F.lit(0).alias("days_past_due"), F.lit(False).alias("is_delinquent")), now)


def fact_fraud_alert(detections: DataFrame, decisions: DataFrame, employee: DataFrame,
                     now: str, review_from: float = REVIEW_FROM) -> DataFrame:
    """One alert per detection at or above the review score, with the analyst's decision.

    ``decisions``: transaction_id, is_confirmed_fraud, resolution_minutes, analyst_id.
    """
    alerts = detections.filter(F.col("fraud_score") >= review_from)
    staff = current(employee).select(F.col("employee_id").alias("analyst_id"), "employee_key")
    df = alerts.join(one_decision(decisions), "transaction_id", "left").join(staff, "analyst_id", "left")
    return with_audit(df.select(
        surrogate_key("transaction_id", "model_key").alias("alert_key"), "transaction_id",
        "transaction_fact_key", "customer_key", "account_key", "model_key",
        or_unknown("employee_key").alias("employee_key"),
        F.col("detection_date_key").alias("alert_date_key"), "fraud_score", "risk_indication",
        "fraud_type", "is_confirmed_fraud", "resolution_minutes",
        F.when(F.col("is_confirmed_fraud").isNull(), "PENDING").otherwise("RESOLVED")
        .alias("alert_status")), now)


def label_writeback(fact_txn: DataFrame, decisions: DataFrame, label_day: str,
                    source: str, decided_only: bool = False) -> DataFrame:
    """Fill the label columns from decided reviews; other rows keep what they have, or are left out
    (``decided_only``) where a merge keeps them anyway."""
    decided = one_decision(decisions).filter(F.col("is_confirmed_fraud").isNotNull()).select(
        "transaction_id", F.col("is_confirmed_fraud").alias("_label"))
    df = fact_txn.join(decided, "transaction_id", "inner" if decided_only else "left")
    has = F.col("_label").isNotNull()
    key = date_key(F.lit(label_day).cast("date"))
    return df.withColumns({
        "is_fraud_confirmed": F.coalesce("_label", "is_fraud_confirmed"),
        "fraud_label_date_key": F.when(has, key).otherwise(F.col("fraud_label_date_key")),
        "fraud_label_source": F.when(has, F.lit(source)).otherwise(F.col("fraud_label_source")),
    }).select(*fact_txn.columns)


def with_usd(fact: DataFrame, rates: DataFrame, columns: list[str], day) -> DataFrame:
    """Add ``<column>_usd`` at the rate of the currency on ``day``; no rate gives NULL.

    ``rates``: currency, rate_date, usd_rate.
    """
    df = fact.withColumn("rate_date", F.to_date(day)).join(rates, ["currency", "rate_date"], "left")
    usd = {f"{c}_usd": F.round(F.col(c) * F.col("usd_rate"), 2).cast("decimal(18,2)") for c in columns}
    return df.withColumns(usd).select(*fact.columns, *usd)
