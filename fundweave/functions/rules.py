"""Typed casts and business rules on numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds the results depend on.
CALENDAR_FIRST_DAY = "1950-01-01"
CALENDAR_LAST_DAY = "2035-12-31"
FIRST_PUBLICATION_YEAR = 1500
START_YEAR_MIN, START_YEAR_MAX = 1900, 2100
UNKNOWN_DATE_KEY = -1

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}"


def safe_money(c: Column) -> Column:
    return F.trim(c).try_cast("decimal(18,2)")


def safe_int(c: Column) -> Column:
    """Rounds fractions half away from zero instead of rejecting them."""
    return F.round(F.trim(c).try_cast("decimal(38,6)"), 0).try_cast("int")


def safe_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def safe_bool(c: Column) -> Column:
    return F.trim(c).try_cast("boolean")


def safe_date(c: Column) -> Column:
    """Only texts that start with a full ISO day are dates; a bare year is not."""
    return F.when(c.rlike(_ISO_DAY), c.try_cast("date"))


def safe_timestamp(c: Column) -> Column:
    return F.when(c.rlike(_ISO_DAY), c.try_cast("timestamp_ntz"))


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def non_negative_or_null(c: Column) -> Column:
    return F.when(c >= 0, c)


def is_non_positive(c: Column) -> Column:
    return F.coalesce(c <= 0, F.lit(False))


def year_in_range(year: Column, as_of: Column) -> Column:
    """NULL for a NULL year, otherwise whether the year is plausible at `as_of`."""
    return year.between(F.lit(FIRST_PUBLICATION_YEAR), F.year(as_of) + 1)


def start_from_year(year: Column) -> Column:
    usable = year.between(START_YEAR_MIN, START_YEAR_MAX)
    return F.when(usable, F.make_date(year, F.lit(1), F.lit(1)))


def ends_before(end: Column, start: Column) -> Column:
    return F.coalesce(end < start, F.lit(False))


def date_key(day: Column) -> Column:
    """Integer YYYYMMDD inside the calendar range, -1 elsewhere."""
    known = day.between(
        F.lit(CALENDAR_FIRST_DAY).cast("date"), F.lit(CALENDAR_LAST_DAY).cast("date")
    )
    digits = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(known, digits).otherwise(F.lit(UNKNOWN_DATE_KEY))


def us_fiscal_year(day: Column) -> Column:
    """Year that contains the day three months later (October opens the next fiscal year)."""
    return F.year(F.add_months(day, 3))


def equal_and_known(a: Column, b: Column) -> Column:
    """1.0 when both sides are known and equal, 0.0 otherwise."""
    return F.coalesce((a == b).cast("double"), F.lit(0.0))


def percentage(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100) * part / F.nullif(whole, F.lit(0)), 2)
