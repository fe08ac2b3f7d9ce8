"""Sources: CSV/Parquet readers with declared schemas, null tokens, record checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benefitlens.constants import CSV_NULL_TOKENS, SCORING_DEFAULTS
from benefitlens.schemas import EMP_SCHEMA, REGION_SCHEMA


def null_tokens_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Turn pandas-style null tokens in text columns into SQL NULL.

    Spark's CSV reader knows a single ``nullValue``; pandas knows a list, which
    it compares exactly: `` NA `` with blanks stays, and so does the word ``none``.
    """
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tokens = F.array(*[F.lit(t) for t in CSV_NULL_TOKENS])
    return df.withColumns({
        c: F.when(F.array_contains(tokens, F.col(c)), F.lit(None).cast("string"))
            .otherwise(F.col(c))
        for c in cols
    })


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the declared types; unparseable values become null."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(c.alias(f.name))
        else:
            out.append(F.trim(c).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """IO1/IO2: header CSV read as text, null tokens cleared, then typed.

    Quotes inside quoted fields are doubled, as pandas reads them.
    ``multi_line`` allows line breaks inside quoted fields; files then can't be
    split among tasks, so it's an option for files that have such breaks.

    Reading every column as text first keeps pandas' wider null-token list and
    lets malformed numbers become null instead of failing the scan.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", True).option("quote", '"').option("escape", '"')
           .option("multiLine", multi_line).option("mode", "PERMISSIVE").csv(path))
    return _typed(null_tokens_to_null(raw), schema)


def read_employees_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv_typed(spark, path, EMP_SCHEMA, multi_line)


def read_regions_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, REGION_SCHEMA)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project a frame onto a declared schema (same names, declared types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_default_columns(df: DataFrame, defaults: dict | None = None,
                         schema: T.StructType = EMP_SCHEMA) -> DataFrame:
    """IO4: add every absent raw column with its default value (typed)."""
    defaults = SCORING_DEFAULTS if defaults is None else defaults
    types = {f.name: f.dataType for f in schema.fields}
    missing = {c: F.lit(v).cast(types.get(c, T.StringType()))
               for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def validate_records(records: DataFrame, regions: DataFrame, require_rows: bool = False) -> DataFrame:
    """IO3 re-aimed for tables: every arriving record plus a ``reason``.

    ``reason`` is null for a valid record, else ``missing_region`` or
    ``unknown_region``.  A table without the ``region`` column cannot be
    planned and raises at once, as the reference raises for it; with
    ``require_rows`` an empty batch input raises too.
    """
    if "region" not in records.columns:
        raise ValueError("Missing required input column(s): ['region']")
    if require_rows and not records.isStreaming and records.isEmpty():  # reads at most one row
        raise ValueError("Input DataFrame is empty.")
    known = regions.select(F.col("region").alias("_known_region")).distinct()
    # The dimension is tiny and its size is checked before broadcasting.
    from benefitlens.operators.joins import broadcast_if_small
    known = broadcast_if_small(known)
    joined = records.join(known, records["region"] == known["_known_region"], "left")
    reason: Column = (F.when(F.col("region").isNull(), F.lit("missing_region"))
                      .when(F.col("_known_region").isNull(), F.lit("unknown_region")))
    return joined.withColumn("reason", reason).drop("_known_region")
