"""Hashes, surrogate keys and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.parsing import _col, blank_to_null

UNKNOWN_KEY = "-1"
UNKNOWN_DATE_KEY = -1


def surrogate_key(*columns) -> Column:
    """MD5 text key over one or more business key columns."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("_null_")) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def change_hash(*columns) -> Column:
    """MD5 over the trimmed tracked columns; NULL and blank count as equal."""
    return F.md5(
        F.concat_ws("|", *[F.coalesce(F.trim(_col(c)), F.lit("")) for c in columns])
    )


def card_hash(c) -> Column:
    """SHA-256 of the trimmed card number; blank stays NULL."""
    return F.sha2(blank_to_null(c), 256)


def row_hash(columns) -> Column:
    """SHA-256 over all columns, with NULL told apart from blank."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def date_key(c, missing: int | None = UNKNOWN_DATE_KEY) -> Column:
    key = F.date_format(_col(c), "yyyyMMdd").cast("int")
    return key if missing is None else F.coalesce(key, F.lit(missing))


def or_unknown(c) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_KEY))


def packed_key(c) -> Column:
    """The 16 bytes of an MD5 text key, for shuffles. Other text becomes longer: 16 bytes are always a hash."""
    other = F.concat(F.unhex(F.lit("00" * 17)), F.encode(_col(c), "UTF-8"))
    return F.when(_col(c).rlike(r"^[0-9a-f]{32}\z"), F.unhex(_col(c))).otherwise(other)


def unpacked_key(c) -> Column:
    """The text of packed_key()."""
    text = F.decode(F.substring(_col(c), 18, 2**31 - 1), "UTF-8")
    return F.when(F.octet_length(_col(c)) == 16, F.lower(F.hex(_col(c)))).otherwise(text)
