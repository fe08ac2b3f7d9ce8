"""Lenient mixed-format date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns tried in order.  ISO always wins; dates with the year last are read
# day-first or month-first, falling back to the other reading when the first is
# impossible.
_ISO = ["yyyy-M-d", "yyyy/M/d", "yyyyMMdd"]
_TEXT = ["MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "MMMM d yyyy", "MMMM d, yyyy", "d MMMM yyyy"]
DAY_FIRST = _ISO + ["d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy"] + _TEXT
MONTH_FIRST = _ISO + ["M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy"] + _TEXT
# Two-digit years from this one on belong to the last century.
_PIVOT = 2069
_TIME = r"[T ](\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d*)?)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _may_match(t: Column, pattern: str) -> Column:
    """False only for a text that lacks a character the pattern requires: a failed
    attempt costs an exception, many times a look at the text."""
    if pattern == "yyyyMMdd":
        return ~t.contains("/")
    if pattern in _TEXT:
        return t.contains(" ")
    if pattern == "yyyy/M/d":
        return F.instr(t, "/") > 4  # a year has at least four digits
    return t.contains("/" if "/" in pattern else "-")


def _try_dates(t: Column, patterns) -> Column:
    return F.coalesce(*[F.when(_may_match(t, p), F.try_to_date(t, p)) for p in patterns])


def _parse(c, patterns) -> Column:
    """The date, with any time of day after it left aside."""
    t = F.trim(_col(c))
    t = F.when(t.contains(":"), F.regexp_replace(t, _TIME, "")).otherwise(t)
    two_digits = _try_dates(t, [p.replace("yyyy", "yy") for p in patterns if p in ("d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy")])
    two_digits = F.when(F.year(two_digits) >= _PIVOT, F.add_months(two_digits, -1200)).otherwise(two_digits)
    return F.coalesce(_try_dates(t, patterns), two_digits)


def parse_day_first(c) -> Column:
    """like pandas ``format='mixed', dayfirst=True, errors='coerce'``."""
    return _parse(c, DAY_FIRST)


def parse_month_first(c) -> Column:
    """like pandas ``format='mixed', errors='coerce'`` (month-first)."""
    return _parse(c, MONTH_FIRST)


def seconds_of_day(c) -> Column:
    """Seconds of the time of day that follows a date in the text; 0 without one, null for an impossible one."""
    t = F.trim(_col(c))
    h, m, s = (F.regexp_extract(t, _TIME, g).try_cast("int") for g in (1, 2, 3))
    s = F.coalesce(s, F.lit(0))
    of_day = F.when(h.isNull(), 0).when((h < 24) & (m < 60) & (s < 60), h * 3600 + m * 60 + s)
    return F.when(t.contains(":"), of_day).otherwise(0)


def moment(date: Column, c) -> Column:
    """Seconds since the epoch of a parsed date and the time of day in its text."""
    return F.unix_date(date).cast("bigint") * 86400 + seconds_of_day(c)


def days_between(later: Column, earlier: Column) -> Column:
    """whole days ``later - earlier`` of two dates; null when either side is null."""
    return F.datediff(later, earlier)


def days_between_moments(later: Column, earlier: Column) -> Column:
    """The difference of two moments in whole days, rounded down as pandas' ``.dt.days``."""
    return F.floor((later - earlier) / 86400).cast("int")


def after_flag(a: Column, b: Column) -> Column:
    """``a > b`` as 0/1, where a comparison with a missing side is 0 (G1)."""
    return F.coalesce(a > b, F.lit(False)).cast("int")


def present_flag(c: Column) -> Column:
    """parsed (not merely present) as 0/1."""
    return c.isNotNull().cast("int")
