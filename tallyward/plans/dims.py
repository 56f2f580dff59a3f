"""Dimension tables. Type 1 are rebuilt; customer, account and employee carry Type-2 columns.

A version's key includes its first day, so values that come back later get a key of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.dates import age_band, iso_weekday
from tallyward.functions.keys import date_key, or_unknown, surrogate_key
from tallyward.sources.sinks import with_audit


def _first_key(name: str, *columns):
    return surrogate_key(*columns).alias(name)


def _with_parent(df: DataFrame, dim: DataFrame, on: str, key: str) -> DataFrame:
    """Resolve a parent's surrogate key; no parent gives the unknown member."""
    found = df.join(dim.select(on, key), on, "left")
    return found.withColumn(key, or_unknown(key))


def _versioned(df: DataFrame, as_of: str) -> DataFrame:
    """Full-refresh Type-2 columns: everything current from ``as_of``."""
    if "effective_date" in df.columns:
        return df
    return df.withColumns({
        "effective_date": F.lit(as_of).cast("date"),
        "expiry_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    })


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def dim_branch(stg: DataFrame, now: str) -> DataFrame:
    return with_audit(stg.select(_first_key("branch_key", "branch_id"), "*"), now)


def dim_department(stg: DataFrame, branch: DataFrame, now: str) -> DataFrame:
    df = _with_parent(stg, branch, "branch_id", "branch_key")
    return with_audit(df.select(
        _first_key("department_key", "department_id"), "department_id", "department_name",
        F.col("manager_id").alias("manager_key"), "branch_key"), now)


def dim_employee(stg: DataFrame, department: DataFrame, branch: DataFrame, as_of: str,
                 now: str) -> DataFrame:
    df = _with_parent(stg, department, "department_id", "department_key")
    df = _versioned(_with_parent(df, branch, "branch_id", "branch_key"), as_of)
    return with_audit(df.select(
        _first_key("employee_key", "employee_id", "scd2_hash", "effective_date"), "employee_id", "first_name",
        "last_name", "full_name", "email", "phone_number", "date_of_birth", "hire_date",
        "position", "salary", "department_key", "branch_key",
        F.col("supervisor_id").alias("supervisor_key"), "scd2_hash",
        "effective_date", "expiry_date", "is_current"), now)


def dim_transaction_type(stg: DataFrame, now: str) -> DataFrame:
    return with_audit(
        stg.select(_first_key("transaction_type_key", "transaction_type_id"), "*"), now)


def dim_merchant(stg: DataFrame, now: str) -> DataFrame:
    return with_audit(stg.select(_first_key("merchant_key", "merchant_id"), "*"), now)


def dim_atm(stg: DataFrame, branch: DataFrame, now: str) -> DataFrame:
    df = _with_parent(stg, branch, "branch_id", "branch_key")
    return with_audit(df.select(
        _first_key("atm_key", "atm_id"), "atm_id", F.col("location").alias("location_name"),
        "street_address", "city", "state", "country", "postal_code", "latitude", "longitude",
        "branch_key", "atm_type", "manufacturer", "model", "max_withdrawal_amount",
        "atm_status"), now)


def primary_phones(stg_phone: DataFrame) -> DataFrame:
    """One primary number per customer (the smallest, should there be several)."""
    return (
        stg_phone.filter("is_primary").groupBy("customer_id")
        .agg(F.min("phone_number").alias("primary_phone"))
    )


def dim_customer(stg: DataFrame, phones: DataFrame | None, as_of: str, now: str) -> DataFrame:
    """Customers with age bands; ``phones`` is the staged phone table, if loaded."""
    if phones is None:
        df = stg.withColumn("primary_phone", F.lit(None).cast("string"))
    else:
        df = stg.join(primary_phones(phones), "customer_id", "left")
    df = _versioned(df, as_of)
    return with_audit(df.select(
        _first_key("customer_key", "customer_id", "scd2_hash", "effective_date"), "customer_id", "first_name",
        "last_name", "full_name", "email", "date_of_birth",
        age_band("date_of_birth", F.lit(as_of).cast("date")).alias("age_band"),
        "gender", "marital_status", "occupation", "street_address", "city", "state", "country",
        "postal_code", "customer_segment", F.col("id_type").alias("ic_type"), "id_number",
        "primary_phone", "scd2_hash", "effective_date", "expiry_date", "is_current"), now)


def dim_account(stg: DataFrame, customer: DataFrame, branch: DataFrame, as_of: str,
                now: str) -> DataFrame:
    df = _with_parent(stg, current(customer), "customer_id", "customer_key")
    df = _versioned(_with_parent(df, branch, "branch_id", "branch_key"), as_of)
    return with_audit(df.select(
        _first_key("account_key", "account_number", "scd2_hash", "effective_date"), "account_number",
        "customer_key", "branch_key", "account_type", "account_status", "currency", "open_date",
        "last_activity_date", "interest_rate", "minimum_balance", "overdraft_limit",
        "scd2_hash", "effective_date", "expiry_date", "is_current"), now)


def dim_card(stg: DataFrame, account: DataFrame, now: str) -> DataFrame:
    df = _with_parent(stg, current(account), "account_number", "account_key")
    return with_audit(df.select(
        _first_key("card_key", "card_number_hashed"), "card_number_hashed", "account_key",
        "card_type", "card_network", "issue_date", "card_expiry_date", "card_holder_name",
        "daily_withdrawal_limit", "daily_purchase_limit", "single_txn_limit", "card_status"),
        now)


# Registry columns that only training can fill, with their types.
REGISTRY_COLUMNS = {
    "algorithm": "string", "framework": "string", "training_date": "date",
    "training_data_from": "date", "training_data_to": "date", "deploy_date": "date",
    "retire_date": "date", "threshold_score": "decimal(6,4)", "precision_score": "decimal(6,4)",
    "recall_score": "decimal(6,4)", "f1_score": "decimal(6,4)", "auc_roc": "decimal(6,4)",
    "is_active": "boolean", "feature_list": "string", "description": "string",
}


def dim_fraud_model(stg_detection: DataFrame, registry: DataFrame | None, now: str) -> DataFrame:
    """Models seen in scoring output, with what the registry knows about them."""
    seen = (
        stg_detection.select("model_name", "model_version")
        .dropna(subset=["model_name", "model_version"]).distinct()
    )
    if registry is None:
        df = seen.withColumns({c: F.lit(None).cast(t) for c, t in REGISTRY_COLUMNS.items()})
    else:
        known = {c.lower() for c in registry.columns}
        told = registry.select("model_name", "model_version", *[
            (F.col(c) if c in known else F.lit(None)).cast(t).alias(c)
            for c, t in REGISTRY_COLUMNS.items()])
        df = seen.join(told, ["model_name", "model_version"], "left")
    df = df.withColumn("is_active", F.coalesce("is_active", F.lit(True)))
    return with_audit(df.select(
        _first_key("model_key", "model_name", "model_version"), "model_name", "model_version",
        *REGISTRY_COLUMNS), now)


def dim_date(days: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day of the range in a one-row frame, with its calendar parts."""
    d = days.select(F.explode(F.sequence(first, last)).alias("full_date"))
    return d.select(
        date_key("full_date", None).alias("date_key"), "full_date",
        F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"), F.dayofmonth("full_date").alias("day_of_month"),
        iso_weekday("full_date").alias("day_of_week"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.dayofyear("full_date").alias("day_of_year"),
        (iso_weekday("full_date") >= 6).alias("is_weekend"),
        F.trunc("full_date", "month").alias("month_start"),
        F.trunc("full_date", "week").alias("week_start"),
        (F.last_day("full_date") == F.col("full_date")).alias("is_month_end"),
    )


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.lit(first).cast("date").alias("first_day"),
                                 F.lit(last).cast("date").alias("last_day"))
