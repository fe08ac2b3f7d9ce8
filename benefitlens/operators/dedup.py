"""Duplicate keys: drop all, keep first, mark, conflict report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key):
    return [key] if isinstance(key, str) else list(key)


def duplicated_keys(df: DataFrame, key="employee_id") -> DataFrame:
    """Keys held by more than one row.  Only the key columns are shuffled and
    the count is combined map-side, so a hot key costs one row per map task."""
    ks = _keys(key)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1))


def _null_safe_on(left: DataFrame, right: DataFrame, ks):
    cond = None
    for k in ks:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def dedup_keep_none(df: DataFrame, key="employee_id") -> DataFrame:
    """Drop every row of a duplicated key (pandas ``keep=False``).

    Null keys compare equal, as in pandas, so several null-key rows are
    dropped together.  The anti-join side is the (usually small) set of
    duplicated keys; AQE turns it into a broadcast when it is small at run
    time, and splits skewed partitions otherwise.
    """
    ks = _keys(key)
    dups = duplicated_keys(df, ks).select(*ks)
    return df.join(dups, _null_safe_on(df, dups, ks), "left_anti")


def dedup_keep_first(df: DataFrame, key="employee_id", order=None) -> DataFrame:
    """One row per key, the first by an explicit order (nulls first).

    ``min_by`` is a declarative aggregate, so it is combined map-side: a hot
    key never gathers its rows in one task.
    """
    ks = _keys(key)
    order = order or [c for c in df.columns if c not in ks]
    others = [c for c in df.columns if c not in ks]
    picked = df.groupBy(*ks).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]),
                 F.struct(*[F.col(c) for c in order])).alias("_row"))
    return picked.select(*ks, *[F.col(f"_row.{c}").alias(c) for c in others])


def mark_duplicates(df: DataFrame, key="employee_id") -> DataFrame:
    """Add ``dup_count`` (rows sharing the key) and ``is_duplicate``.

    A ``count() over (partition by key)`` window would buffer a hot key in
    one task; a grouped count joined back on the duplicated keys does not.
    """
    ks = _keys(key)
    dups = duplicated_keys(df, ks).select(*[F.col(k).alias(f"_dk_{k}") for k in ks], "_n")
    cond = None
    for k in ks:
        c = df[k].eqNullSafe(dups[f"_dk_{k}"])
        cond = c if cond is None else cond & c
    j = df.join(dups, cond, "left")
    return (j.withColumn("dup_count", F.coalesce(F.col("_n"), F.lit(1)).cast("bigint"))
             .withColumn("is_duplicate", F.col("_n").isNotNull())
             .drop("_n", *[f"_dk_{k}" for k in ks]))


def duplicate_conflicts(df: DataFrame, key="employee_id", label="enrolled") -> DataFrame:
    """Per duplicated key, which columns disagree (null-safe) and the labels.

    A column disagrees when it holds two different values or mixes null and
    non-null (pandas ``nunique(dropna=False) > 1``).  Everything is min/max/
    count, combined map-side; no per-key row list is gathered.  Labels are
    reported as their distinct values (bounded by the label domain).
    """
    ks = _keys(key)
    dups = duplicated_keys(df, ks).select(*ks)
    rows = df.join(dups, ks, "left_semi")
    cols = [c for c in df.columns if c not in ks]
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"_mn_{c}"), F.max(c).alias(f"_mx_{c}"),
                 F.count(c).alias(f"_nn_{c}")]
    aggs.append(F.array_sort(F.collect_set(F.col(label).cast("string"))).alias("_labels"))
    g = rows.groupBy(*ks).agg(*aggs)
    differs = {c: (F.coalesce(F.col(f"_mn_{c}") != F.col(f"_mx_{c}"), F.lit(False))
                   | ((F.col(f"_nn_{c}") > 0) & (F.col(f"_nn_{c}") < F.col("n_rows"))))
               for c in cols}
    feature_diff = [differs[c] for c in cols if c != label]
    any_feature = F.lit(False)
    for d in feature_diff:
        any_feature = any_feature | d
    return g.select(
        *ks, "n_rows",
        F.concat_ws(",", *[F.when(differs[c], F.lit(c)) for c in cols]).alias("differing_columns"),
        (~any_feature).alias("features_identical"),
        (~differs[label]).alias("labels_identical"),
        F.array_join(F.col("_labels"), ",").alias("label_values"),
    )


def duplicates_by_region(df: DataFrame, key="employee_id", by="region") -> DataFrame:
    """Duplicated rows per region and the number of pairs (rows // 2)."""
    marked = mark_duplicates(df, key).filter("is_duplicate")
    return (marked.groupBy(by).agg(F.count(F.lit(1)).cast("bigint").alias("dup_rows"))
            .withColumn("dup_pairs", F.floor(F.col("dup_rows") / 2).cast("bigint")))
