"""Fraud features as column expressions over enriched transactions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import days_between, iso_weekday
from tallyward.operators.velocity import FIGURES


@dataclass(frozen=True)
class Thresholds:
    """Limits and weights of the rules. The defaults are the fixed values of the rule book."""

    high_value: float = 10000
    night_start: int = 23
    night_end: int = 4
    new_days: int = 90
    dormant_days: int = 180
    velocity_1h: int = 5
    unusual_factor: float = 3
    weights: dict = field(default_factory=lambda: {
        "is_high_value": 3, "is_international": 2, "is_night_transaction": 1,
        "location_mismatch": 2, "is_new_account": 1, "is_dormant_account": 2,
        "below_minimum_balance": 1, "inactive_account": 2, "inactive_customer": 3,
    })
    segments: dict = field(default_factory=lambda: {"Premium": -1, "VIP": -2, "Standard": 0})
    other_segment: int = 1


DEFAULTS = Thresholds()

# The model's inputs, in model order.
ML_FEATURES = """amount transaction_hour transaction_day_of_week is_weekend
    is_night_transaction amount_to_balance_ratio amount_to_available_ratio is_high_value
    balance_utilization below_minimum_balance is_home_city is_home_country
    location_mismatch is_new_account is_dormant_account customer_age_days
    customer_tenure_days is_new_customer is_active_account is_active_customer
    is_withdrawal is_transfer is_purchase is_deposit is_atm is_online is_mobile is_branch
    risk_score_base combined_risk_score account_age_days days_since_last_activity
    transactions_last_1h transactions_last_24h amount_last_1h amount_last_24h
    avg_amount_24h is_high_velocity is_unusual_amount""".split()

# Codes of the transaction types and channels that get a flag.
TYPE_FLAGS = {"is_deposit": 1, "is_purchase": 2, "is_withdrawal": 3, "is_transfer": 4}
CHANNEL_FLAGS = {"is_atm": "ATM", "is_online": "Online", "is_mobile": "Mobile",
                 "is_branch": "Branch"}


def _bit(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _double(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _word(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.round(F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0)), 6)


def features_time(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    hour = F.coalesce(F.hour("transaction_date"), F.lit(0))
    weekday = F.coalesce(iso_weekday("transaction_date"), F.lit(1))
    return df.withColumns({
        "transaction_hour": hour,
        "transaction_day_of_week": weekday,
        "is_weekend": _bit(weekday >= 6),
        "is_night_transaction": _bit((hour >= t.night_start) | (hour <= t.night_end)),
    })


def features_amount(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    amount, balance = _double("amount"), _double("current_balance")
    return df.withColumns({
        "amount_to_balance_ratio": _ratio(amount, balance),
        "amount_to_available_ratio": _ratio(amount, _double("available_balance")),
        "amount_change": F.col("balance_before") - F.col("balance_after"),
        "is_high_value": _bit(F.col("amount") > t.high_value),
        "balance_utilization": _ratio(amount, balance + _double("overdraft_limit")),
        "below_minimum_balance": _bit(balance < _double("minimum_balance")),
    })


def features_location(df: DataFrame) -> DataFrame:
    """Missing places count as equal to each other, so two missing cities are 'home'."""
    city = _bit(_word("city") == _word("customer_city"))
    country = _bit(_word("country") == _word("customer_country"))
    return df.withColumns({
        "is_home_city": city,
        "is_home_country": country,
        "location_mismatch": F.lit(2) - city - country,
    })


def features_account(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    age = days_between("transaction_date", "account_open_date")
    idle = days_between("transaction_date", "last_activity_date")
    return df.withColumns({
        "account_age_days": age,
        "is_new_account": _bit(age < t.new_days),
        "days_since_last_activity": idle,
        "is_dormant_account": _bit(idle > t.dormant_days),
        "is_active_account": _bit(F.col("account_status") == "Active"),
        "is_active_customer": _bit(F.col("customer_is_active")),
    })


def features_customer(df: DataFrame, as_of: str, t: Thresholds = DEFAULTS) -> DataFrame:
    reference = F.coalesce("transaction_date", F.lit(as_of).cast("timestamp"))
    tenure = days_between(reference, "customer_since")
    return df.withColumns({
        "customer_age_days": days_between(reference, "customer_created_date"),
        "customer_tenure_days": tenure,
        "is_new_customer": _bit(tenure < t.new_days),
    })


def features_type_channel(df: DataFrame) -> DataFrame:
    types = {n: _bit(F.col("transaction_type_id") == code) for n, code in TYPE_FLAGS.items()}
    channels = {n: _bit(F.col("channel") == word) for n, word in CHANNEL_FLAGS.items()}
    return df.withColumns({**types, **channels})


def features_risk(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Weighted sum of the flags, then the segment adjustment. Needs the other groups."""
    signals = {
        "is_international": F.col("is_international").cast("int"),
        "inactive_account": F.lit(1) - F.col("is_active_account"),
        "inactive_customer": F.lit(1) - F.col("is_active_customer"),
    }
    base = F.lit(0)
    for name, weight in t.weights.items():
        base = base + signals.get(name, F.col(name)) * F.lit(weight)
    segment = F.lit(t.other_segment)
    for name, shift in t.segments.items():
        segment = F.when(F.col("customer_segment") == name, shift).otherwise(segment)
    return df.withColumns({"risk_score_base": base, "segment_risk_adjustment": segment}).withColumn(
        "combined_risk_score", F.col("risk_score_base") + F.col("segment_risk_adjustment")
    )


def features_velocity(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Flags from the sliding figures; without figures each row counts only itself."""
    if FIGURES[0] not in df.columns:
        alone = [F.lit(1), F.lit(1), F.col("amount"), F.col("amount"), F.col("amount")]
        df = df.withColumns(dict(zip(FIGURES, alone)))
    average = F.col("avg_amount_24h")
    unusual = (average > 0) & (F.col("amount") > average * t.unusual_factor)
    return df.withColumns({
        "is_high_velocity": _bit(F.col("transactions_last_1h") >= t.velocity_1h),
        "is_unusual_amount": _bit(unusual),
    })


def features(df: DataFrame, as_of: str, t: Thresholds = DEFAULTS) -> DataFrame:
    """All feature groups over enriched rows that carry (or lack) the velocity figures."""
    df = features_time(df, t)
    df = features_amount(df, t)
    df = features_location(df)
    df = features_account(df, t)
    df = features_customer(df, as_of, t)
    df = features_type_channel(df)
    df = features_risk(df, t)
    return features_velocity(df, t)


def feature_matrix(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The key and the 39 model inputs as doubles, in model order; missing becomes 0."""
    return df.select(key, *[_double(c).alias(c) for c in ML_FEATURES])
