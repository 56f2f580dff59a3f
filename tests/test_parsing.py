"""Every branch of the scalar rules, on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyward.functions import dates as FD
from tallyward.functions import keys as K
from tallyward.functions import parsing as P


def one(spark, value, how):
    return spark.createDataFrame([(value,)], "x string").select(how("x").alias("y")).first()[0]


@pytest.mark.parametrize("value, want", [
    ("1749379721000000000", datetime(2025, 6, 8, 10, 48, 41)),
    ("1749379721000000", datetime(2025, 6, 8, 10, 48, 41)),
    ("1749379721000", datetime(2025, 6, 8, 10, 48, 41)),
    ("1749379721", datetime(2025, 6, 8, 10, 48, 41)),
    ("1749379721.5", datetime(2025, 6, 8, 10, 48, 41, 500000)),
    ("999", None), ("-5", None), ("99999999999999999999999", None), ("", None), (None, None),
    ("2024-01-05T10:00:00", datetime(2024, 1, 5, 10)),
    ("2024-01-05T10:00:00.25", datetime(2024, 1, 5, 10, 0, 0, 250000)),
    ("2024-01-05 10:00:00", datetime(2024, 1, 5, 10)),
    ("2024-01-05T10:00:00Z", datetime(2024, 1, 5, 10)),
    ("2024-01-05T10:00:00+02:00", datetime(2024, 1, 5, 10)),
    ("2024-01-05", datetime(2024, 1, 5)), ("2024-13-05", None), ("2024", None), ("soon", None),
    ("9223372036854775807", datetime(2262, 4, 11, 23, 47, 16, 854775)),
])
def test_parse_datetime(spark, value, want):
    got = one(spark, value, lambda c: F.date_format(P.parse_datetime(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S.%f"))


@pytest.mark.parametrize("value, want", [
    ("TRUE", True), (" yes ", True), ("1", True), ("no", False), ("2", False), ("", False), (None, False)])
def test_flag(spark, value, want):
    assert one(spark, value, P.flag) is want


@pytest.mark.parametrize("value, want", [("12.345", "12.35"), (" -3 ", "-3.00"), ("1e3", "1000.00"), ("n/a", None)])
def test_number(spark, value, want):
    got = one(spark, value, P.number)
    assert (None if got is None else str(got)) == want


def test_whole_and_safe_numbers(spark):
    assert one(spark, "3.7", P.whole) == 4
    assert one(spark, "3.7", P.safe_int) == 3
    assert one(spark, "x", P.safe_int) == 0
    assert one(spark, None, P.safe_double) == 0.0


def test_days(spark):
    assert one(spark, "2024-01-05", P.day) == date(2024, 1, 5)
    assert one(spark, "2024-1-5", P.day) is None
    assert one(spark, "05/2027", P.any_day) is None


def test_hashes(spark):
    import hashlib

    assert one(spark, " 4111 ", K.card_hash) == hashlib.sha256(b"4111").hexdigest()
    assert one(spark, "  ", K.card_hash) is None
    assert one(spark, None, K.change_hash) == one(spark, " ", K.change_hash)
    assert one(spark, None, K.surrogate_key) == hashlib.md5(b"_null_").hexdigest()
    assert one(spark, None, lambda c: K.date_key(P.parse_datetime(c))) == -1


@pytest.mark.parametrize("a, b, want", [
    ("2024-01-02", "2024-01-01", 1), ("2024-01-01", "2024-01-02", 1),
    ("2024-01-01 00:00:00", "2024-01-01 12:00:00", 1),  # floor of minus a half is minus one
    ("2024-01-01 12:00:00", "2024-01-01 00:00:00", 0), (None, "2024-01-01", 0)])
def test_days_between(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(FD.days_between(P.parse_datetime("a"), P.parse_datetime("b"))).first()[0] == want


def test_boundaries(spark):
    df = spark.sql("select date'2000-12-31' a, date'2024-01-01' b")
    row = df.select(FD.year_boundaries("a", "b"), FD.month_boundaries("a", "b"), FD.iso_weekday("b"),
                    FD.age_band("a", F.col("b"))).first()
    assert tuple(row) == (24, 277, 1, "18-25")
