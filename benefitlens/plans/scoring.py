"""Deterministic stand-in score (FIXTURES.md 'scored') and output normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benefitlens.operators.dedup import dedup_keep_none


def fixture_score() -> Column:
    """A rule score in [0.05, 0.94] with many ties, used where a V key needs a
    model output that both engines can compute."""
    return (F.lit(0.05)
            + F.when(F.col("has_dependents") == "Yes", F.lit(0.45)).otherwise(F.lit(0.0))
            + F.when(F.col("salary") >= 60000.0, F.lit(0.25)).otherwise(F.lit(0.0))
            + F.when(F.col("employment_type") == "Full-time", F.lit(0.1)).otherwise(F.lit(0.0))
            + (F.col("employee_id") % 10) / F.lit(100.0))


def scored_fixture(emp: DataFrame) -> DataFrame:
    """Deduplicated rows with the stand-in probability ``p``."""
    d = dedup_keep_none(emp, "employee_id")
    return d.select("employee_id", "region", "employment_type", "enrolled", fixture_score().alias("p"))


def normalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Integral columns as BIGINT, floating columns rounded: the form both
    engines of the value check agree on."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)
