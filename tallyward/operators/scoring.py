"""From a fraud score to bands, actions, fraud types and the two output streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower bound of each band, its risk word and action, highest first.
BANDS = ((0.8, "Critical", "Block"), (0.6, "High", "Flag"), (0.4, "Medium", "Step-Up-Auth"))
LOWEST_BAND = ("Low", "Pass")
REVIEW_FROM = 0.6
DEFAULT_THRESHOLD = 0.5


@dataclass(frozen=True)
class ModelId:
    name: str = "tally-rules"
    version: str = "v1"


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def risk_bands(df: DataFrame, raw: str = "raw_score") -> DataFrame:
    """Bands and confidence on the unrounded score; the emitted score has four decimals."""
    s = F.col(raw)
    risk, action = F.lit(LOWEST_BAND[0]), F.lit(LOWEST_BAND[1])
    for bound, word, deed in reversed(BANDS):
        risk = F.when(s >= bound, word).otherwise(risk)
        action = F.when(s >= bound, deed).otherwise(action)
    return df.withColumns({
        "fraud_score": F.round(s, 4),
        "confidence_score": F.round(F.abs(s - 0.5) * 2, 4),
        "risk_indication": risk,
        "action_taken": action,
    })


def fraud_type(df: DataFrame) -> DataFrame:
    """First matching rule names the type; NULL where no fraud is predicted."""
    def on(*names):
        hit = F.col(names[0]) == 1
        for n in names[1:]:
            hit = hit & (F.col(n) == 1)
        return hit

    # The names of the fraud types, in the order of their rules.
    rules = [
        (F.col("location_mismatch") >= 2, "Account-Takeover"),
        (on("is_online", "is_high_value"), "Card-Not-Present"),
        (on("is_atm", "is_night_transaction"), "ATM-Skimming"),
        (on("is_new_account", "is_high_value"), "New-Account-Fraud"),
        (on("is_dormant_account"), "Dormant-Account-Takeover"),
    ]
    kind = F.lit("Suspicious-Transaction")
    for condition, word in reversed(rules):
        kind = F.when(condition, word).otherwise(kind)
    return df.withColumn("fraud_type", F.when(F.col("is_fraud_predicted"), kind))


def label_scores(df: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                 outlier: str | None = None) -> DataFrame:
    """Prediction, bands and type from ``raw_score`` (and an optional outlier flag)."""
    predicted = F.col("raw_score") >= threshold
    if outlier:
        predicted = F.col(outlier) | predicted
    return fraud_type(risk_bands(df.withColumn("is_fraud_predicted", predicted)))


def score_defaults(df: DataFrame) -> DataFrame:
    """What is emitted while there is no model: nothing is suspected."""
    return df.withColumns({
        "fraud_score": F.lit(0.0),
        "is_fraud_predicted": F.lit(False),
        "confidence_score": F.lit(0.0),
        "fraud_type": F.lit(None).cast("string"),
        "risk_indication": F.lit(LOWEST_BAND[0]),
        "action_taken": F.lit(LOWEST_BAND[1]),
    })


def rule_score(df: DataFrame, top: float = 16.0) -> DataFrame:
    """Model-free score: the combined risk scaled to [0, 1]."""
    return df.withColumn("raw_score", clamp01(F.col("combined_risk_score").cast("double") / top))


def split_streams(scored: DataFrame, model: ModelId) -> tuple[DataFrame, DataFrame]:
    """One scored row to a transaction row and a detection row, under their stored names."""
    from tallyward.schemas import REALTIME_ENGINEERED, REALTIME_PASS_THROUGH

    transactions = scored.select(
        *[F.col(stored_source(c)).alias(c) for c in REALTIME_PASS_THROUGH],
        *[F.col(c) for c in REALTIME_ENGINEERED],
        *(["is_late"] if "is_late" in scored.columns else []),
    )
    name = F.col("model_name") if "model_name" in scored.columns else F.lit(model.name)
    version = F.col("model_version") if "model_version" in scored.columns else F.lit(model.version)
    latency = (F.col("inference_latency_ms") if "inference_latency_ms" in scored.columns
               else F.lit(0.0))
    detections = scored.select(
        F.col("transaction_id").alias("TransactionID"),
        "fraud_score", "is_fraud_predicted", "confidence_score", "fraud_type",
        "risk_indication", "action_taken", latency.alias("inference_latency_ms"),
        "processing_timestamp", name.alias("model_name"), version.alias("model_version"),
        (F.col("fraud_score") >= REVIEW_FROM).alias("is_review_required"),
    )
    return transactions, detections


# Stored names whose words are not split where the rule below would split them.
_ODD = {"ATMID": "atm_id", "IPAddress": "ip_address"}


def stored_source(name: str) -> str:
    """Column behind a stored name: TransactionID -> transaction_id."""
    if name in _ODD:
        return _ODD[name]
    out = ""
    for i, ch in enumerate(name):
        starts_word = ch.isupper() and i > 0 and not name[i - 1].isupper()
        out += ("_" if starts_word else "") + ch.lower()
    return out
