"""Dimension joins with size-checked broadcast, joins that spread hot keys."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it is proven to have at most this many rows.
BROADCAST_MAX_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """Bounded check: scans at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise a shuffle join is planned."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def dimension_profile(dim: DataFrame, key: str) -> tuple[int, bool]:
    """One small job on the dimension: its row count and whether the key is unique."""
    r = dim.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("nk"),
                F.count_distinct(key).alias("dk")).first()
    return int(r["n"]), r["nk"] == r["dk"]


def assert_unique_key(dim: DataFrame, key: str) -> int:
    """J2 (dimension side): the join key is unique, so a left join keeps row counts."""
    n, unique = dimension_profile(dim, key)
    if not unique:
        raise ValueError(f"dimension key '{key}' is not unique")
    return n


#: A key with this share of a side's rows or more is hot; at most 1 / HOT_SHARE keys of a side are.
HOT_SHARE = 0.001
#: Rows of hot keys that are broadcast; with more of them on both sides, they're salted.
HOT_BROADCAST = 100_000
#: Rows of one key and salt that a salted join brings together, about.
SALT_ROWS = 50_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """(key, n) of the keys that hold ``share`` of the rows or more: a bounded
    table, from counts that are combined map-side."""
    from benefitlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    least = max(2, math.ceil(share * df.count()))
    known = df.select(key).filter(F.col(key).isNotNull())
    return known.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).checkpoint(eager=True)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = HOT_SHARE,
                most_broadcast: int = HOT_BROADCAST, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``left.join(right, key, how)`` for inner and left joins, in which no task
    gets a hot key of ``left`` as a whole.

    Rows of ``left`` with a hot key stay where they are and meet the broadcast
    rows of ``right`` with these keys, if those are few (one a key where
    ``right`` is a dimension).  If not, both sides' rows of hot keys are salted:
    each row of ``left`` gets one of a key's salts, each row of ``right`` all of
    them, as many as the key's rows ask for.  All other rows are joined by key.
    Null keys match nothing and aren't moved.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join does inner and left joins")
    hot = hot_keys(left, key, share)
    few = F.broadcast(hot.select(key))
    known = left.filter(F.col(key).isNotNull())
    cold = known.join(few, key, "left_anti").join(right, key, how)
    hot_left, hot_right = known.join(few, key, "left_semi"), right.join(few, key, "left_semi")
    if row_count_at_most(hot_right, most_broadcast):
        hot_rows = hot_left.join(F.broadcast(hot_right), key, how)
    else:
        salts = F.broadcast(hot.select(key, F.ceil(F.col("n") / F.lit(salt_rows)).cast("int").alias("_salts")))
        # a salt made of the row's content would put equal rows together, so it's drawn, and written down to stay when
        # a task is run again
        salted = hot_left.join(salts, key).withColumn("_salt", F.floor(F.rand(42) * F.col("_salts")).cast("int")).drop("_salts")
        salted = salted.checkpoint(eager=True)
        copies = hot_right.join(salts, key).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
        hot_rows = salted.join(copies, [key, "_salt"], how).drop("_salt")
    out = cold.unionByName(hot_rows)
    if how == "inner":
        return out
    return out.unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)


def join_dimension(fact: DataFrame, dim: DataFrame, key: str = "region",
                   how: str = "left", check_unique: bool = True,
                   max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left equi-join of the fact to a dimension.

    The dimension is profiled once (row count and key uniqueness); it is
    broadcast only when that count is within the bound, otherwise the fact's
    hot keys are spread (``spread_join``) and the rest is joined by key.
    """
    n, unique = dimension_profile(dim, key)
    if check_unique and not unique:
        raise ValueError(f"dimension key '{key}' is not unique")
    if n <= max_broadcast_rows:
        return fact.join(F.broadcast(dim), key, how)
    return spread_join(fact, dim, key, how) if how in ("inner", "left") else fact.join(dim, key, how)


def join_cardinality(fact: DataFrame, dim: DataFrame, key: str = "region") -> DataFrame:
    """J2 as a one-row report, computed in one lazy pass over the fact.

    Each fact row is matched to the number of dimension rows holding its key;
    the left join keeps the row count exactly when every match count is <= 1.
    """
    dk = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    j = fact.join(broadcast_if_small(dk), key, "left")
    m = F.coalesce(F.col("_m"), F.lit(1))
    return (j.agg(F.count(F.lit(1)).cast("bigint").alias("rows_before"),
                  F.sum(m).cast("bigint").alias("rows_after"),
                  (F.max(m) <= 1).alias("dim_key_unique"))
             .withColumn("cardinality_ok", F.col("rows_before") == F.col("rows_after")))


def unmatched_keys(fact: DataFrame, dim: DataFrame, key: str = "region") -> DataFrame:
    """Keys present on one side only, both directions, as (side, key)."""
    fk = fact.select(key).distinct()
    dk = dim.select(key).distinct()
    left = fk.join(dk, key, "left_anti").select(F.lit("fact_only").alias("side"), F.col(key))
    right = dk.join(fk, key, "left_anti").select(F.lit("dimension_only").alias("side"), F.col(key))
    return left.unionByName(right)


def null_report(joined: DataFrame, columns) -> DataFrame:
    """Null count of each joined-in column, one pass, unpivoted."""
    agg = joined.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "null_count")


def reconcile(fact: DataFrame, dim: DataFrame, key: str, pairs) -> DataFrame:
    """Computed aggregates beside published ones, full outer on the key.

    ``pairs`` is a list of (name, fact aggregate Column, dimension column).
    Output columns: key, then ``<name>_actual``, ``<name>_published``,
    ``<name>_diff`` for each pair.
    """
    computed = fact.groupBy(key).agg(*[agg.alias(f"{name}_actual") for name, agg, _ in pairs])
    published = dim.select(key, *[F.col(d).cast("double").alias(f"{name}_published")
                                  for name, _, d in pairs])
    j = computed.join(broadcast_if_small(published), key, "full_outer")
    return j.withColumns({
        f"{name}_diff": F.abs(F.col(f"{name}_actual").cast("double") - F.col(f"{name}_published"))
        for name, _, _ in pairs
    })


def any_true(conds):
    return reduce(lambda a, b: a | b, conds)


def match_requests(requests: DataFrame, known: DataFrame, key: str = "employee_id"):
    """Requested keys that exist (semi-join) and those that do not
    (anti-join, reported instead of silently dropped)."""
    ids = known.select(key).distinct()
    return (requests.join(ids, key, "left_semi"), requests.join(ids, key, "left_anti"))
