"""Category codes (F18) and label encoding of every text column.

Codes are the alphabetical position of a level among the distinct levels,
computed with the distributed scan in ``prefix_sums``: no level list is
gathered on the driver and no single task sorts all levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.operators.joins import BROADCAST_MAX_ROWS
from benefitlens.operators.prefix import dense_codes
from benefitlens.schemas import numeric_columns, text_columns


def _codes_side(codes: DataFrame) -> DataFrame:
    return F.broadcast(codes) if codes.count() <= BROADCAST_MAX_ROWS else codes


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """alphabetical codes, null -> -1."""
    codes = _codes_side(dense_codes(df, column, f"{column}_code"))
    out = df.join(codes, column, "left")
    return out.withColumn(f"{column}_code", F.coalesce(F.col(f"{column}_code"), F.lit(-1)).cast("int"))


def label_encode_all(df: DataFrame, exclude=("employee_id", "enrolled"), missing: str = "nan",
                     numeric_fill: float = -999.0) -> DataFrame:
    """every text column coded alphabetically with a missing value as its
    own level (the text 'nan'); numeric nulls filled with a sentinel.

    All text columns are unpivoted once and coded in one grouped scan.
    """
    texts = [c for c in text_columns(df) if c not in exclude]
    nums = [c for c in numeric_columns(df) if c not in exclude]
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in texts})
    long = filled.select(*texts).unpivot([], texts, "column_name", "value")
    codes = _codes_side(dense_codes(long, "value", "code", groups=["column_name"]))
    out = filled
    for c in texts:
        side = codes.filter(F.col("column_name") == c).select(F.col("value").alias(c),
                                                              F.col("code").cast("int").alias(f"{c}_code"))
        out = out.join(side, c, "left")
    return out.select(*[c for c in exclude if c in df.columns],
                      *[F.coalesce(F.col(c).cast("double"), F.lit(numeric_fill)).alias(c) for c in nums],
                      *[F.col(f"{c}_code") for c in texts])
