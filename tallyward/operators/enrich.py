"""Lookup joins of transactions with account and customer data.

All are left equi joins on a key that is unique on the right side. No side is marked for
broadcast: Spark broadcasts a side only when its size, estimated or measured by AQE, is
under ``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles and splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.keys import card_hash
from tallyward.functions.parsing import (
    flag, is_blank, number, parse_datetime, safe_double, safe_int, text,
)
from tallyward.operators.dedup import latest_per_key


def _latest(raw: DataFrame, key: str) -> DataFrame:
    return latest_per_key(raw.filter(~is_blank(key)), key, [F.col("_LOAD_TS").desc_nulls_last()])


def live_transactions(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed view of change events or RAW rows; text stays as sent, as features compare it raw.
    The columns ``carry`` come along."""
    def maybe(name):
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    return raw.select(
        text("TransactionID").alias("transaction_id"),
        text("AccountNumber").alias("account_number"),
        F.nullif(text(maybe("CustomerID")), F.lit("")).alias("event_customer_id"),
        F.col("MerchantID").alias("merchant_id"),
        F.col("ATMID").alias("atm_id"),
        card_hash("CardNumber").alias("card_number_hashed"),
        parse_datetime("TransactionDate").alias("transaction_date"),
        F.coalesce(number("Amount"), F.lit(0).cast("decimal(18,2)")).alias("amount"),
        F.col("Currency").alias("currency"),
        safe_int("TransactionTypeID").alias("transaction_type_id"),
        F.col("TransactionMethod").alias("transaction_method"),
        F.coalesce("Channel", F.lit("")).alias("channel"),
        F.col("TransactionStatus").alias("transaction_status"),
        F.coalesce("City", F.lit("")).alias("city"),
        F.col("State").alias("state"),
        F.coalesce("Country", F.lit("")).alias("country"),
        safe_double("Latitude").alias("latitude"),
        safe_double("Longitude").alias("longitude"),
        flag("IsInternational").alias("is_international"),
        F.col("DeviceID").alias("device_id"),
        F.col("DeviceType").alias("device_type"),
        F.col("IPAddress").alias("ip_address"),
        F.coalesce(number(maybe("BalanceBefore")), F.lit(0)).cast("decimal(18,2)").alias("balance_before"),
        F.coalesce(number(maybe("BalanceAfter")), F.lit(0)).cast("decimal(18,2)").alias("balance_after"),
        *carry,
    )


def live_accounts(raw: DataFrame) -> DataFrame:
    """Latest row per account, with the twelve fields the lookup adds."""
    a = _latest(raw, "AccountNumber")
    return a.select(
        text("AccountNumber").alias("account_number"),
        text("CustomerID").alias("customer_id"),
        F.col("AccountType").alias("account_type"),
        F.col("AccountStatus").alias("account_status"),
        number("Balance").alias("current_balance"),
        number("AvailableBalance").alias("available_balance"),
        parse_datetime("OpenDate").alias("account_open_date"),
        parse_datetime("LastActivityDate").alias("last_activity_date"),
        F.col("BranchID").alias("branch_id"),
        F.col("Currency").alias("account_currency"),
        number("InterestRate", 10, 4).alias("interest_rate"),
        number("MinimumBalance").alias("minimum_balance"),
        number("OverdraftLimit").alias("overdraft_limit"),
    )


def live_customers(raw: DataFrame) -> DataFrame:
    """Latest row per customer, with the thirteen fields the lookup adds."""
    c = _latest(raw, "CustomerID")
    return c.select(
        text("CustomerID").alias("customer_id"),
        F.col("FirstName").alias("customer_first_name"),
        F.col("LastName").alias("customer_last_name"),
        F.col("Email").alias("customer_email"),
        F.col("DateOfBirth").alias("customer_dob"),
        F.col("Gender").alias("customer_gender"),
        F.col("Occupation").alias("customer_occupation"),
        F.col("City").alias("customer_city"),
        F.col("State").alias("customer_state"),
        F.col("Country").alias("customer_country"),
        F.col("CustomerSegment").alias("customer_segment"),
        parse_datetime("CustomerSince").alias("customer_since"),
        flag("IsActive").alias("customer_is_active"),
        parse_datetime("CreatedDate").alias("customer_created_date"),
    )


def enrich_account(txn: DataFrame, account: DataFrame) -> DataFrame:
    """Add the account fields; a miss leaves them NULL."""
    return txn.join(account, "account_number", "left")


def enrich_customer(txn: DataFrame, customer: DataFrame) -> DataFrame:
    """Add the customer fields through the account's customer, else the id on the event."""
    key = F.coalesce(F.nullif(F.col("customer_id"), F.lit("")), F.col("event_customer_id"))
    keyed = txn.withColumn("customer_id", key).drop("event_customer_id")
    return keyed.join(customer, "customer_id", "left")


def two_tier_lookup(df: DataFrame, fresh: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Look a key up in a fresh snapshot, and in the base snapshot where that misses.

    A hit is taken whole: a NULL field of a fresh row is not filled from the base row.
    """
    fields = [c for c in fresh.columns if c != key]
    one = fresh.select(key, F.struct(*fields).alias("_fresh"))
    two = base.select(key, F.struct(*fields).alias("_base"))
    hit = F.coalesce(F.col("_fresh"), F.col("_base"))
    tier = F.when(F.col("_fresh").isNotNull(), "fresh").when(F.col("_base").isNotNull(), "base")
    return (
        df.join(one, key, "left").join(two, key, "left")
        .withColumn("_hit", hit)
        .select(*df.columns, *[F.col("_hit")[c].alias(c) for c in fields],
                F.coalesce(tier, F.lit("miss")).alias("lookup_tier"))
    )


def dimension_health(dims: dict[str, DataFrame]) -> DataFrame:
    """Row count of each lookup table and a warning where one is empty."""
    out = None
    for name, df in dims.items():
        one = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dimension"), "n_rows", (F.col("n_rows") == 0).alias("is_empty")
        )
        out = one if out is None else out.unionByName(one)
    return out
