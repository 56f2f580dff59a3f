"""The ten standard questions over the star schema.

Facts are reduced on their keys before a dimension is joined wherever the measure allows it,
so frequent keys meet the join as one row. Score averages are taken over decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.plans.dims import current

_SCORE = "decimal(10,4)"


def _share(part: Column, whole: Column, digits: int = 6) -> Column:
    ratio = part.cast("double") / whole.cast("double")
    return F.round(F.when(whole > 0, ratio), digits)


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("int")), F.lit(0))


def model_precision_recall(detection: DataFrame, alert: DataFrame, model: DataFrame) -> DataFrame:
    truth = alert.filter(F.col("is_confirmed_fraud").isNotNull()).select(
        "transaction_id", "model_key", "is_confirmed_fraud")
    predicted, fraud = F.col("is_fraud_predicted"), F.col("is_confirmed_fraud")
    counts = (
        detection.select("transaction_id", "model_key", "is_fraud_predicted")
        .join(truth, ["transaction_id", "model_key"], "left").groupBy("model_key")
        .agg(F.count("*").alias("n_scored"),
             _count_if(fraud.isNotNull()).alias("n_labelled"),
             _count_if(predicted & fraud).alias("true_positives"),
             _count_if(predicted & ~fraud).alias("false_positives"),
             _count_if(~predicted & fraud).alias("false_negatives"))
    )
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    names = model.select("model_key", "model_name", "model_version")
    return counts.join(names, "model_key", "left").select(
        "model_name", "model_version", "n_scored", "n_labelled", tp, fp, fn,
        _share(tp, tp + fp).alias("precision"), _share(tp, tp + fn).alias("recall"))


def fpr_by_merchant_category(alert: DataFrame, fact_txn: DataFrame, merchant: DataFrame) -> DataFrame:
    decided = alert.filter(F.col("is_confirmed_fraud").isNotNull())
    at = fact_txn.select("transaction_fact_key", "merchant_key")
    per_merchant = decided.join(at, "transaction_fact_key", "left").groupBy("merchant_key").agg(
        F.count("*").alias("n"), _count_if(~F.col("is_confirmed_fraud")).alias("bad"))
    category = F.coalesce("merchant_category", F.lit("Unknown"))
    return (
        per_merchant.join(merchant.select("merchant_key", "merchant_category"), "merchant_key", "left")
        .groupBy(category.alias("merchant_category"))
        .agg(F.sum("n").alias("n_decided"), F.sum("bad").alias("n_false_positive"))
        .withColumn("false_positive_rate", _share(F.col("n_false_positive"), F.col("n_decided")))
    )


def customer_risk_trend(detection: DataFrame, customer: DataFrame, dates: DataFrame,
                        period: str = "month") -> DataFrame:
    """Average score per customer and month (or week), with the change to the period before."""
    start = f"{period}_start"
    daily = detection.groupBy("customer_key", F.col("detection_date_key").alias("date_key")).agg(
        F.count("*").alias("n"), F.sum(F.col("fraud_score").cast(_SCORE)).alias("total"),
        F.max("fraud_score").alias("top"))
    per = daily.join(dates.select("date_key", start), "date_key", "left").groupBy(
        "customer_key", F.col(start).alias("period_start")).agg(
        F.sum("n").alias("n_scored"), F.sum("total").alias("total"), F.max("top").alias("max_score"))
    per = per.withColumn("avg_score", F.round(F.col("total").cast("double") / F.col("n_scored"), 6))
    # Scores without a date, or with one outside the calendar, are a period of their own (NULL).
    w = Window.partitionBy("customer_key", F.col("period_start").isNull()).orderBy("period_start")
    trend = per.withColumn("previous_avg_score", F.lag("avg_score").over(w))
    names = customer.select("customer_key", "customer_id", "customer_segment")
    return trend.join(names, "customer_key", "left").select(
        "customer_key", "customer_id", "customer_segment", "period_start", "n_scored",
        "avg_score", "max_score", "previous_avg_score",
        F.round(F.col("avg_score") - F.col("previous_avg_score"), 6).alias("score_change"))


def alert_sla(alert: DataFrame, employee: DataFrame, dates: DataFrame,
              sla_minutes: int = 240) -> DataFrame:
    """Resolved alerts within the agreed minutes, per analyst and month."""
    minutes = F.col("resolution_minutes")
    resolved = alert.filter(minutes.isNotNull()).join(
        dates.select(F.col("date_key").alias("alert_date_key"), "year", "month"), "alert_date_key", "left")
    counted = resolved.groupBy("employee_key", "year", "month").agg(
        F.count("*").alias("n_resolved"),
        _count_if(minutes <= sla_minutes).alias("n_within_sla"),
        F.round(F.percentile(minutes, F.lit(0.5)), 4).alias("median_minutes"),
        F.max(minutes).alias("max_minutes"))
    names = employee.select("employee_key", "employee_id", "full_name")
    return counted.join(names, "employee_key", "left").select(
        "employee_key", "employee_id", "full_name", "year", "month", "n_resolved",
        "n_within_sla", _share(F.col("n_within_sla"), F.col("n_resolved")).alias("sla_rate"),
        "median_minutes", "max_minutes")


def volume_by_channel_country(fact_txn: DataFrame, dates: DataFrame, account: DataFrame) -> DataFrame:
    df = (
        fact_txn.select("date_key", "account_key", "channel", "country", "amount")
        .join(account.select("account_key", "account_type"), "account_key", "left")
        .groupBy("date_key", "channel", "country", "account_type")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    )
    return (
        df.join(dates.select("date_key", "year", "month"), "date_key", "left")
        .groupBy("year", "month", "channel", "country",
                 F.coalesce("account_type", F.lit("Unknown")).alias("account_type"))
        .agg(F.sum("n").alias("n_transactions"),
             F.sum("total").cast("decimal(28,2)").alias("total_amount"))
    )


def loan_portfolio_monthly(loan: DataFrame, customer: DataFrame, dates: DataFrame) -> DataFrame:
    rate = F.sum("interest_rate").cast("double") / F.count("interest_rate")
    return (
        loan.join(customer.select("customer_key", "customer_segment"), "customer_key", "left")
        .join(dates.select(F.col("date_key").alias("snapshot_date_key"), "year", "month"),
              "snapshot_date_key", "left")
        .groupBy("year", "month", "snapshot_date_key",
                 F.coalesce("customer_segment", F.lit("Unknown")).alias("customer_segment"))
        .agg(F.count("*").alias("n_loans"),
             F.sum("outstanding_amount").cast("decimal(28,2)").alias("outstanding"),
             F.sum("loan_amount").cast("decimal(28,2)").alias("granted"),
             F.round(rate, 6).alias("avg_interest_rate"))
    )


def balance_anomalies(snapshot: DataFrame, account: DataFrame, dates: DataFrame,
                      trailing: int = 7, limit: float = 2.0) -> DataFrame:
    """Snapshots whose balance is far from the account's previous ``trailing`` ones."""
    w = Window.partitionBy("account_key").orderBy("snapshot_date_key").rowsBetween(-trailing, -1)
    b = F.col("balance")
    total, squares = F.sum(b).over(w), F.sum((b * b).cast("decimal(36,4)")).over(w)
    df = snapshot.filter(b.isNotNull()).withColumns({
        "n": F.count(b).over(w), "s": total.cast("double"), "q": squares.cast("double"),
    })
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    spread = F.sqrt(F.greatest(F.lit(0.0), (n * q - s * s) / (n * (n - 1))))
    df = df.filter(n >= 3).withColumns({"mean": s / n, "spread": spread})
    z = (b.cast("double") - F.col("mean")) / F.col("spread")
    df = df.filter(F.col("spread") > 0.005).withColumn("z_score", F.round(z, 3))
    return (
        df.filter(F.abs("z_score") >= limit)
        .select("account_key", "snapshot_date_key", "balance", "mean", "spread", "z_score")
        .join(account.select("account_key", "account_number"), "account_key", "left")
        .join(dates.select(F.col("date_key").alias("snapshot_date_key"), "full_date"),
              "snapshot_date_key", "left")
        .select("account_number", "full_date", "balance", F.round("mean", 2).alias("trailing_mean"),
                F.round("spread", 2).alias("trailing_spread"), "z_score")
    )


def fraud_hotspots(fact_txn: DataFrame, atm: DataFrame, merchant: DataFrame,
                   top: int = 20) -> DataFrame:
    """Cities with the most confirmed fraud at ATMs and merchants."""
    links = [("ATM", "atm_key", atm), ("MERCHANT", "merchant_key", merchant)]
    used = F.array(*[F.struct(F.lit(kind).alias("place_kind"), F.col(key).alias("place_key")) for kind, key, _ in links])
    # One pass over the facts: each row counts for its ATM and for its merchant.
    per_place = fact_txn.select("is_fraud_confirmed", F.inline(used)).filter(F.col("place_key") != "-1").groupBy(
        "place_kind", "place_key").agg(F.count("*").alias("n"), _count_if(F.col("is_fraud_confirmed")).alias("bad"))
    places = [dim.select(F.lit(kind).alias("place_kind"), F.col(key).alias("place_key"),
                         F.col("city").alias("place_city"), F.col("country").alias("place_country"))
              for kind, key, dim in links]
    both = per_place.join(places[0].unionByName(places[1]), ["place_kind", "place_key"]).groupBy(
        "place_kind", "place_city", "place_country").agg(
        F.sum("n").alias("n_transactions"), F.sum("bad").alias("n_fraud")).filter("n_fraud > 0")
    both = both.withColumn("fraud_rate", _share(F.col("n_fraud"), F.col("n_transactions")))
    return both.orderBy(F.col("n_fraud").desc(), F.col("fraud_rate").desc(), "place_kind",
                        "place_city", "place_country").limit(top)


def score_drift(detection: DataFrame, model: DataFrame, dates: DataFrame, bins: int = 10,
                floor: float = 0.0001, period: str = "month") -> DataFrame:
    """Population stability index of each period's score histogram against the model's first."""
    start = f"{period}_start"
    b = F.least(F.floor(F.col("fraud_score") * bins), F.lit(bins - 1)).cast("int")
    counts = (
        detection.groupBy("model_key", F.col("detection_date_key").alias("date_key"), b.alias("bin"))
        .agg(F.count("*").alias("n"))
        .join(dates.select("date_key", F.col(start).alias("period_start")), "date_key", "left")
        .groupBy("model_key", "period_start", "bin").agg(F.sum("n").alias("n"))
    )
    # From here on there are at most models x periods x bins rows.
    per = counts.groupBy("model_key", "period_start").agg(
        F.sum("n").alias("n_scored"), F.map_from_entries(
            F.collect_list(F.struct("bin", "n"))).alias("hist"))
    share = F.greatest(F.coalesce(F.col("hist")[F.col("bin")], F.lit(0)).cast("double")
                       / F.col("n_scored"), F.lit(floor))
    dense = per.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumn("p", share)
    w = Window.partitionBy("model_key", "bin").orderBy(F.asc_nulls_last("period_start"))
    psi = dense.withColumn("q", F.first("p").over(w)).groupBy(
        "model_key", "period_start", "n_scored").agg(
        F.round(F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))), 6).alias("psi"))
    names = model.select("model_key", "model_name", "model_version")
    return psi.join(names, "model_key", "left").select(
        "model_name", "model_version", "period_start", "n_scored", "psi")


def label_rate_by_analyst(alert: DataFrame, employee: DataFrame, dates: DataFrame) -> DataFrame:
    fraud = F.col("is_confirmed_fraud")
    counted = (
        alert.join(dates.select(F.col("date_key").alias("alert_date_key"), "year", "month"),
                   "alert_date_key", "left")
        .groupBy("employee_key", "year", "month")
        .agg(F.count("*").alias("n_alerts"), _count_if(fraud.isNotNull()).alias("n_labelled"),
             _count_if(fraud).alias("n_confirmed"))
    )
    return counted.join(employee.select("employee_key", "employee_id"), "employee_key", "left").select(
        "employee_key", "employee_id", "year", "month", "n_alerts", "n_labelled", "n_confirmed",
        _share(F.col("n_labelled"), F.col("n_alerts")).alias("label_rate"),
        _share(F.col("n_confirmed"), F.col("n_labelled")).alias("confirmed_rate"))
