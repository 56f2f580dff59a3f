"""Features and scores against a plain Python model on random rows, and the band edges."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyward.operators.features import ML_FEATURES, Thresholds, feature_matrix, features
from tallyward.operators.scoring import ModelId, label_scores, score_defaults, split_streams
from tallyward.schemas import REALTIME_DETECTION, REALTIME_ENGINEERED, REALTIME_PASS_THROUGH

SCHEMA = """transaction_id string, transaction_date timestamp, amount decimal(18,2),
    balance_before decimal(18,2), balance_after decimal(18,2), current_balance decimal(18,2),
    available_balance decimal(18,2), overdraft_limit decimal(18,2), minimum_balance decimal(18,2),
    city string, customer_city string, country string, customer_country string,
    account_open_date timestamp, last_activity_date timestamp, customer_created_date timestamp,
    customer_since timestamp, account_status string, customer_is_active boolean,
    transaction_type_id int, channel string, is_international boolean, customer_segment string"""
AS_OF = "2024-02-01"


def maybe(rng, value, share=0.2):
    return None if rng.random() < share else value


def make(n):
    from decimal import Decimal as D

    rng, rows = random.Random(5), []
    for i in range(n):
        t = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 30))

        def past():
            return t - timedelta(hours=rng.randrange(24 * 400) - 200)

        money = lambda top: D(rng.randrange(-100, top)) / 4
        rows.append((
            f"X{i}", maybe(rng, t), money(90000), money(100), money(100), maybe(rng, money(90000)),
            maybe(rng, money(900)), maybe(rng, money(900)), maybe(rng, money(900)),
            maybe(rng, rng.choice("ab")), maybe(rng, rng.choice("ab")), maybe(rng, rng.choice("cd")),
            maybe(rng, rng.choice("cd")), maybe(rng, past()), maybe(rng, past()), maybe(rng, past()),
            maybe(rng, past()), maybe(rng, rng.choice(["Active", "active", "Frozen"])),
            maybe(rng, rng.random() < 0.5), rng.randrange(6),
            rng.choice(["ATM", "Online", "Mobile", "Branch", "POS", "atm", ""]), rng.random() < 0.3,
            maybe(rng, rng.choice(["Premium", "VIP", "Standard", "Basic"]))))
    return rows


def model(r):
    """One row at a time, from the written rules."""
    g = dict(zip([c.split()[0] for c in SCHEMA.replace("(18,2)", "").split(",")], r))
    num = lambda k: float(g[k] or 0)
    t, o = g["transaction_date"], {}

    def gap(a, b):
        return 0 if a is None or b is None else abs((a - b).days)

    o["transaction_hour"] = t.hour if t else 0
    o["transaction_day_of_week"] = t.isoweekday() if t else 1
    o["is_weekend"] = int(o["transaction_day_of_week"] > 5)
    o["is_night_transaction"] = int(o["transaction_hour"] in (23, 0, 1, 2, 3, 4))
    amount, balance = num("amount"), num("current_balance")
    o["is_high_value"] = int(amount > 10000)
    o["below_minimum_balance"] = int(balance < num("minimum_balance"))
    o["is_home_city"] = int((g["city"] or "") == (g["customer_city"] or ""))
    o["is_home_country"] = int((g["country"] or "") == (g["customer_country"] or ""))
    o["location_mismatch"] = 2 - o["is_home_city"] - o["is_home_country"]
    o["account_age_days"] = gap(t, g["account_open_date"])
    o["is_new_account"] = int(o["account_age_days"] < 90)
    o["days_since_last_activity"] = gap(t, g["last_activity_date"])
    o["is_dormant_account"] = int(o["days_since_last_activity"] > 180)
    ref = t or datetime(2024, 2, 1)
    o["customer_age_days"] = gap(ref, g["customer_created_date"])
    o["customer_tenure_days"] = gap(ref, g["customer_since"])
    o["is_new_customer"] = int(o["customer_tenure_days"] < 90)
    o["is_active_account"] = int(g["account_status"] == "Active")
    o["is_active_customer"] = int(bool(g["customer_is_active"]))
    for name, code in (("is_deposit", 1), ("is_purchase", 2), ("is_withdrawal", 3), ("is_transfer", 4)):
        o[name] = int(g["transaction_type_id"] == code)
    for name, word in (("is_atm", "ATM"), ("is_online", "Online"), ("is_mobile", "Mobile"), ("is_branch", "Branch")):
        o[name] = int(g["channel"] == word)
    o["risk_score_base"] = (3 * o["is_high_value"] + 2 * g["is_international"] + o["is_night_transaction"]
                            + 2 * o["location_mismatch"] + o["is_new_account"] + 2 * o["is_dormant_account"]
                            + o["below_minimum_balance"] + 2 * (1 - o["is_active_account"])
                            + 3 * (1 - o["is_active_customer"]))
    o["segment_risk_adjustment"] = {"Premium": -1, "VIP": -2, "Standard": 0}.get(g["customer_segment"], 1)
    o["combined_risk_score"] = o["risk_score_base"] + o["segment_risk_adjustment"]
    return o, amount, balance, num


def test_features_match_the_rules(spark):
    rows = make(400)
    got = {r["transaction_id"]: r for r in features(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()}
    seen = {}
    for r in rows:
        want, amount, balance, num = model(r)
        row = got[r[0]]
        for name, value in want.items():
            assert row[name] == value, (r[0], name)
            seen.setdefault(name, set()).add(value)
        for name, below in (("amount_to_balance_ratio", balance), ("amount_to_available_ratio", num("available_balance")),
                            ("balance_utilization", balance + num("overdraft_limit"))):
            assert row[name] == pytest.approx(amount / below if below > 0 else 0.0, abs=1e-6)
        assert row["transactions_last_1h"] == 1 and row["is_high_velocity"] == 0
    assert all(len(values) > 1 for values in seen.values())


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame(make(50), SCHEMA)
    t = Thresholds(high_value=-1e9, new_days=10**6)
    flags = features(df, AS_OF, t).agg(F.min("is_high_value"), F.min("is_new_account")).first()
    assert tuple(flags) == (1, 1)


def test_matrix_has_39_filled_columns(spark):
    df = features(spark.createDataFrame(make(50), SCHEMA), AS_OF)
    m = feature_matrix(df)
    assert m.columns == ["transaction_id", *ML_FEATURES] and len(ML_FEATURES) == 39
    assert m.dropna().count() == 50


FLAGS = ("location_mismatch", "is_online", "is_high_value", "is_atm", "is_night_transaction",
         "is_new_account", "is_dormant_account")


@pytest.mark.parametrize("score, want", [
    (0.39999, ("Low", "Pass", 0.4, 0.2)), (0.4, ("Medium", "Step-Up-Auth", 0.4, 0.2)),
    (0.6, ("High", "Flag", 0.6, 0.2)), (0.8, ("Critical", "Block", 0.8, 0.6)), (0.0, ("Low", "Pass", 0.0, 1.0))])
def test_bands(spark, score, want):
    df = spark.createDataFrame([(score, *[0] * 7)], ["raw_score", *FLAGS])
    r = label_scores(df).first()
    assert (r["risk_indication"], r["action_taken"], r["fraud_score"], r["confidence_score"]) == want
    assert r["is_fraud_predicted"] == (score >= 0.5)


@pytest.mark.parametrize("flags, want", [
    ((2, 1, 1, 1, 1, 1, 1), "Account-Takeover"), ((1, 1, 1, 1, 1, 1, 1), "Card-Not-Present"),
    ((0, 0, 1, 1, 1, 1, 1), "ATM-Skimming"), ((0, 1, 0, 1, 0, 1, 1), "Dormant-Account-Takeover"),
    ((0, 0, 1, 0, 1, 1, 1), "New-Account-Fraud"), ((1, 0, 0, 0, 0, 0, 0), "Suspicious-Transaction")])
def test_fraud_type(spark, flags, want):
    df = spark.createDataFrame([(0.9, *flags), (0.1, *flags)], ["raw_score", *FLAGS])
    assert sorted(r["fraud_type"] or "" for r in label_scores(df).collect()) == ["", want]


def test_defaults_and_split(spark, bank):
    r = score_defaults(spark.range(1)).first()
    assert (r["fraud_score"], r["confidence_score"], r["fraud_type"], r["action_taken"]) == (0.0, 0.0, None, "Pass")
    txn, det = split_streams(bank.scored_runs, ModelId("m", "v9"))
    assert txn.columns == REALTIME_PASS_THROUGH + REALTIME_ENGINEERED
    assert det.columns == REALTIME_DETECTION


def test_flags_fire_on_some_rows(bank):
    names = [c for c in ML_FEATURES if c.startswith("is_") and c not in ("is_high_velocity",)]
    row = bank.featured.agg(*[F.avg(c).alias(c) for c in names]).first()
    assert all(0 < row[c] < 1 for c in names), row
