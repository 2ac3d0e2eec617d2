"""Calendar functions with year-boundary semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.fixed_values import MAX_CUSTOMER_AGE, TIME_ONLY_DAY


DAY_TIME = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\\z"


def year_gap(earlier: Column, later: Column) -> Column:
    """Calendar-year boundaries between two dates (31 Dec to 1 Jan counts as one)."""
    return F.year(later) - F.year(earlier)


def fix_birth_date(birth: Column, entry: Column) -> Column:
    """Shift a birth date by a century when the age at entry is negative or implausible."""
    gap = year_gap(birth, entry)
    centuries = F.when(gap < 0, -1).when(gap > MAX_CUSTOMER_AGE, 1).otherwise(0)
    return F.add_months(birth, centuries * 1200)


def time_text(c: Column) -> Column:
    """Time of day as HH:mm:ss text, from a time or a full timestamp; unreadable input gives NULL.

    Text that is such a time already is not read and written again.
    """
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(DAY_TIME), text).otherwise(F.date_format(moment(c), "HH:mm:ss"))


def moment(c: Column) -> Column:
    """Text as a point in time; a time without a date is one on TIME_ONLY_DAY."""
    text = F.trim(c.cast("string"))
    dated = F.concat(F.lit(f"{TIME_ONLY_DAY} "), text)
    return F.coalesce(text.try_cast("timestamp_ntz"), dated.try_cast("timestamp_ntz"))


def month_of(c: Column) -> Column:
    return F.trunc(c, "month")
