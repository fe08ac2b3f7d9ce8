"""Median imputation fitted on one subset and applied to all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benefitlens.operators.quantiles import exact_quantiles


def fit_medians(df: DataFrame, columns) -> dict:
    """Exact interpolated median of each column (a bounded dict of scalars,
    like the state of a fitted imputer)."""
    cols = list(columns)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot([], cols, "column_name", "_v")
    rows = exact_quantiles(long, "_v", [0.5], ["column_name"]).collect()
    return {r["column_name"]: r["value"] for r in rows}


def median_impute(df: DataFrame, columns, fit_on: Column | None = None, suffix: str = "_imputed") -> DataFrame:
    """Fill nulls with medians fitted on the rows selected by ``fit_on``
    (e.g. the train split) and applied to every row."""
    med = fit_medians(df.filter(fit_on) if fit_on is not None else df, columns)
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.lit(med.get(c)).cast("double"))
                           for c in columns})
