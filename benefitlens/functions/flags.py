"""Three-valued-logic-safe 0/1 flags (G1) and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benefitlens.constants import AGE_BANDS


def flag(cond: Column) -> Column:
    """A comparison with a missing side counts as False, as in pandas."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def sentinel_flags(c="prior_year_enrolled") -> dict[str, Column]:
    """-1 means 'no record'; 1 means 'enrolled'."""
    col = F.col(c)
    return {"no_prior_record": flag(col == -1), "prior_year_enrolled_clean": flag(col == 1)}


def dependents_flag(c="has_dependents") -> Column:
    """'Yes' -> 1, anything else (incl. null) -> 0."""
    return flag(F.col(c) == F.lit("Yes"))


def tenure_flag(tenure="tenure_years", age="age") -> Column:
    """F16: tenure longer than the years since age 18."""
    return flag(F.col(tenure) > (F.col(age) - F.lit(18)))


def age_band(c="age") -> Column:
    """right-closed bands (20,35], (35,50], (50,65]; others null."""
    col = F.col(c)
    expr = None
    for lo, hi, label in AGE_BANDS:
        cond = (col > lo) & (col <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def nan_to_null(c) -> Column:
    """Turn float NaN into NULL at the source (G1)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col)
