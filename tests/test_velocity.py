"""Sliding figures against a row-at-a-time model, with hot accounts, ties and blanks."""

from pyspark.sql import functions as F
import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallyward.operators.velocity import FIGURES, velocity, velocity_of_batch, velocity_quality

SCHEMA = "transaction_id string, account_number string, transaction_date timestamp, amount decimal(18,2)"
T0 = datetime(2024, 1, 1)
CENT = Decimal("0.01")


def brute(rows):
    out = {}
    for i, a, t, m in rows:
        if a is None or not a.strip():
            out[i] = (1, 1, m, m, m)
            continue
        at = t or datetime(1970, 1, 1)
        mine = [(x[2] or datetime(1970, 1, 1), x[3] or 0) for x in rows if x[1] == a]
        h = [v for u, v in mine if at - timedelta(hours=1) <= u <= at]
        d = [v for u, v in mine if at - timedelta(days=1) <= u <= at]
        out[i] = (len(h), len(d), sum(h, Decimal(0)), sum(d, Decimal(0)),
                  (sum(d, Decimal(0)) / len(d)).quantize(CENT, ROUND_HALF_UP))
    return out


def figures(df):
    return {r["transaction_id"]: tuple(r[f] for f in FIGURES) for r in df.collect()}


def make(n, seed, hot=0.4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        account = rng.choice([None, "", " "]) if rng.random() < 0.05 else (
            "HOT" if rng.random() < hot else f"A{rng.randrange(6)}")
        t = None if rng.random() < 0.02 else T0 + timedelta(seconds=rng.randrange(0, 4 * 86400, 600))
        rows.append((f"X{i}", account, t, Decimal(rng.randrange(-5000, 90000)) / 100))
    return rows


@pytest.mark.parametrize("hot_rows", [10_000, 100, 7])
def test_matches_brute_force(spark, hot_rows):
    rows = make(600, hot_rows)
    assert figures(velocity(spark.createDataFrame(rows, SCHEMA), hot_rows=hot_rows)) == brute(rows)


def test_edges_are_included_and_ties_count(spark):
    def at(seconds, micros=0):
        return T0 + timedelta(seconds=seconds, microseconds=micros)

    rows = [("a", "A", at(0), Decimal(1)), ("b", "A", at(3600), Decimal(2)),
            ("c", "A", at(3600, 1), Decimal(4)), ("d", "A", at(86400), Decimal(8)),
            ("e", "A", at(86400), Decimal(16)), ("f", "A", at(86400, 1), Decimal(32))]
    got = figures(velocity(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert got["b"][0] == 2 and got["c"][0] == 2 and got["d"][:2] == (2, 5) and got["f"][1] == 5


def test_batches_equal_one_pass(spark):
    """Micro-batches in event-time order give the figures of a single pass."""
    rows = sorted([r for r in make(300, 3) if r[2]], key=lambda r: r[2])
    cut = [rows[:100], rows[100:101], rows[101:]]
    seen, got = [], {}
    for part in cut:
        history = spark.createDataFrame(seen, SCHEMA)
        got |= figures(velocity_of_batch(spark.createDataFrame(part, SCHEMA), history, hot_rows=50))
        seen += part
    want = brute(rows)
    ties = {(a, t) for _, a, t, _ in rows if sum(1 for r in rows if r[1] == a and r[2] == t) > 1}
    for i, a, t, _ in rows:
        if (a, t) not in ties:
            assert got[i] == want[i]


def test_update_replaces_stored_row(spark):
    old = spark.createDataFrame([("x", "A", T0, Decimal(5)), ("y", "A", T0, Decimal(7))], SCHEMA)
    new = spark.createDataFrame([("x", "A", T0 + timedelta(minutes=1), Decimal(9))], SCHEMA)
    assert figures(velocity_of_batch(new, old))["x"][:3] == (2, 2, Decimal(16))


def test_quality(spark):
    df = velocity(spark.createDataFrame(make(200, 9), SCHEMA))
    row = velocity_quality(df).first()
    assert row["n_rows"] == 200 and 0 < row["share_different"] < 1


def test_a_foreign_hot_list_changes_nothing(spark):
    """The list only cuts the work: one counted on other, later rows gives the same figures."""
    from tallyward.operators.velocity import hot_accounts

    rows = make(400, 21)
    df = spark.createDataFrame(rows, SCHEMA)
    later = df.filter("transaction_date > timestamp'2024-01-03'")
    hot = hot_accounts(later, hot_rows=5)
    assert hot.count() > 0
    assert figures(velocity(df, hot=hot)) == brute(rows)


def test_untimed_rows_do_not_widen_slices(spark):
    from tallyward.operators.velocity import hot_accounts

    rows = [r for r in make(400, 9, hot=1.0)]
    timed = spark.createDataFrame(rows, SCHEMA).filter("transaction_date is not null")
    untimed = timed.limit(1).withColumn("transaction_date", F.lit(None).cast("timestamp"))
    with_ = hot_accounts(timed.unionByName(untimed), hot_rows=50).first()
    without = hot_accounts(timed, hot_rows=50).first()
    assert with_["_first"] == without["_first"] and with_["_width"] <= without["_width"]


def test_slices_of_a_day_need_one_pass(spark):
    """Rows that reach over a slice's end count in the next one, and the rows are read once."""
    from tallyward.operators.velocity import hot_accounts

    at = [0, 86399, 86400, 86401, 90000, 2 * 86400, 2 * 86400 + 2, 9 * 86400, 10 * 86400, 10 * 86400 + 1]
    rows = [(f"X{i}", "HOT", T0 + timedelta(seconds=s), Decimal(2 ** i)) for i, s in enumerate(at)]
    df = spark.createDataFrame(rows, SCHEMA)
    hot = hot_accounts(df, hot_rows=4)
    assert hot.count() == 1 and not hot.first()["_dense"]
    out = velocity(df, hot=hot)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [transaction_id") == 1
    assert figures(out) == brute(rows)
