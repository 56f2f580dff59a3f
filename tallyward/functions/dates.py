"""Date arithmetic with the warehouse's boundary-counting rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.parsing import _col

MICROS_PER_DAY = 86400 * 10**6


def year_boundaries(start, end) -> Column:
    """Number of 1 January crossings, not of full years."""
    return F.year(_col(end)) - F.year(_col(start))


def month_boundaries(start, end) -> Column:
    return year_boundaries(start, end) * 12 + F.month(_col(end)) - F.month(_col(start))


def days_between(a, b) -> Column:
    """Absolute value of the floored day difference; 0 where either side is missing."""
    micros = F.unix_micros(_col(a)) - F.unix_micros(_col(b))
    return F.coalesce(F.abs(F.floor(micros / F.lit(MICROS_PER_DAY))), F.lit(0)).cast("int")


def iso_weekday(c) -> Column:
    return F.weekday(_col(c)) + 1


def age_band(birth, as_of) -> Column:
    age = year_boundaries(birth, as_of)
    # The age bands and their names.
    bands = [(25, "18-25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (65, "56-65")]
    out = F.when(_col(birth).isNull(), "Unknown").when(age < 18, "Under 18")
    for top, label in bands:
        out = out.when(age <= top, label)
    return out.otherwise("65+")
