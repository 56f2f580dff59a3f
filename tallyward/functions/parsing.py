"""Text to typed columns. Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted words for TRUE; everything else, also NULL, is FALSE.
TRUE_WORDS = ("TRUE", "1", "YES")

_DAY = r"^\d{4}-\d{2}-\d{2}$"
_STAMP = (
    r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)?$"
    r"|^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(Z|[+-]\d{2}:?\d{2})$"
)
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
_MAX_MICROS = 253402300799999999  # 9999-12-31T23:59:59.999999


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    return F.trim(_col(c))


def upper_text(c) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_blank(c) -> Column:
    """TRUE for NULL and for text of spaces only; never NULL."""
    return F.coalesce(F.trim(_col(c).cast("string")) == "", F.lit(True))


def number(c, precision: int = 18, scale: int = 2) -> Column:
    return F.trim(_col(c)).try_cast(f"decimal({precision},{scale})")


def whole(c) -> Column:
    return number(c, 38, 0).try_cast("int")


def real(c) -> Column:
    return F.trim(_col(c)).try_cast("double")


def day(c) -> Column:
    """A date written exactly as yyyy-MM-dd."""
    t = F.trim(_col(c))
    return F.when(t.rlike(_DAY), t.try_cast("date"))


def any_day(c) -> Column:
    """A date in any of Spark's standard forms."""
    return F.trim(_col(c)).try_cast("date")


def flag(c) -> Column:
    return F.coalesce(F.upper(F.trim(_col(c))).isin(*TRUE_WORDS), F.lit(False))


def parse_datetime(c) -> Column:
    """Epoch numbers by magnitude (ns, us, ms, s) or ISO text; an offset is dropped, not applied.

    Works in decimals: a double cannot hold nanoseconds.
    """
    t = F.trim(_col(c).cast("string"))
    n = t.try_cast("decimal(28,6)")
    micros = (
        F.when(n > F.lit(10).cast("decimal(20,0)") * F.lit(10**17), n / 1000)
        .when(n > F.lit(10**15), n)
        .when(n > F.lit(10**12), n * 1000)
        .when(n > F.lit(10**9), n * 1000000)
    )
    micros = F.floor(micros).try_cast("bigint")
    epoch = F.when(micros <= F.lit(_MAX_MICROS), F.timestamp_micros(micros))
    iso = F.when(
        n.isNull() & t.rlike(_STAMP), F.regexp_replace(t, _OFFSET, "").try_cast("timestamp")
    )
    return F.coalesce(epoch, iso)


def safe_double(c, default: float = 0.0) -> Column:
    return F.coalesce(F.trim(_col(c).cast("string")).try_cast("double"), F.lit(default))


def safe_int(c, default: int = 0) -> Column:
    """Integer by truncation of the parsed number."""
    d = F.trim(_col(c).cast("string")).try_cast("double")
    return F.coalesce(d.try_cast("int"), F.lit(default))
