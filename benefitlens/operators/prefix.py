"""Distributed exclusive running sums and ranks (a scan) without a single-task window.

Rows are range-partitioned on (groups..., order), so each slice holds one
contiguous run of the order; the number of slices is Spark's shuffle-partition
setting (AQE merges small ones).  What lies before a slice comes from the
slices' totals, at most #slices + #groups rows since slices are contiguous,
by a scan in two levels: slices are gathered into blocks of about the root of
their number, running sums are taken over the slices of a block and over the
blocks, and both are added.  So no task sums more than that root of a group's
slices, and the cost is linear in the slices.

Used for exact ranking metrics (per distinct score), for dense codes of sorted
distinct levels (both inputs are "one row per distinct key", so a hot key is
already collapsed to one row) and for ranks of whole rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benefitlens.session import ensure_checkpoint_dir


def slice_offsets(totals: DataFrame, sums, groups=(), slice_col: str = "_slice", slices: int | None = None,
                  in_total: bool = True) -> DataFrame:
    """From one row per (slice, groups...) with the slices' sums: the same rows
    with ``<c>_before`` (sum over the group's earlier slices) and, unless
    ``in_total`` is false, ``<c>_total`` (sum over all of them) for every
    column ``c`` in ``sums``.

    ``slice_col`` holds integers in the order of the slices; ``slices`` is
    about how many there are (the shuffle-partition setting unless given).
    """
    groups, sums = list(groups), list(sums)
    slices = slices or int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    block = f"{slice_col}_block"
    t = totals.withColumn(block, F.floor(F.col(slice_col) / F.lit(max(1, math.isqrt(slices)))).cast("long"))
    zero = F.lit(0).cast("long")
    in_block = Window.partitionBy(*groups, block).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    of_blocks = Window.partitionBy(*groups).orderBy(block)
    blocks = t.groupBy(*groups, block).agg(*[F.sum(c).alias(f"_{c}_block") for c in sums])
    blocks = blocks.select(
        *[F.col(g).alias(f"_b{i}") for i, g in enumerate(groups)], F.col(block).alias("_b"),
        *[F.coalesce(F.sum(f"_{c}_block").over(of_blocks.rowsBetween(Window.unboundedPreceding, -1)), zero).alias(f"_{c}_blocks") for c in sums],
        *[F.coalesce(F.sum(f"_{c}_block").over(of_blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), zero).alias(f"{c}_total")
          for c in sums if in_total])
    t = t.withColumns({f"_{c}_in_block": F.coalesce(F.sum(c).over(in_block), zero) for c in sums})
    same = [F.col(block) == F.col("_b")] + [F.col(g).eqNullSafe(F.col(f"_b{i}")) for i, g in enumerate(groups)]
    return t.join(blocks, same).select(
        *totals.columns, *[(F.col(f"_{c}_in_block") + F.col(f"_{c}_blocks")).alias(f"{c}_before") for c in sums],
        *[f"{c}_total" for c in sums if in_total])


def _with_offsets(rows: DataFrame, offsets: DataFrame, groups) -> DataFrame:
    """Each row with the offsets of its slice and group (null groups are groups of their own)."""
    offsets = offsets.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(groups)}).withColumnRenamed("_slice", "_s")
    matches = [F.col("_slice") == F.col("_s")] + [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    return rows.join(offsets, matches)


def prefix_sums(df: DataFrame, order: str, sums, groups=(), slices: int | None = None) -> DataFrame:
    """Adds ``<c>_below`` (sum over rows of the same group with a strictly
    smaller ``order`` value; ``order`` values must be unique within a group)
    and ``<c>_total`` (group total) for every column ``c`` in ``sums``.

    ``slices`` overrides the number of slices (for tests and tuning).  The
    sliced rows are checkpointed, because a slice's number has to stay with its
    rows.  Null sums count as zero; a null group is a group of its own.
    """
    groups, sums = list(groups), list(sums)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = _slices(df, [*groups, order], slices).withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True)
    zero = F.lit(0).cast("long")
    inside = Window.partitionBy("_slice", *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    scanned = ranged.withColumns({f"_{c}_inside": F.coalesce(F.sum(c).over(inside), zero) for c in sums})
    totals = ranged.groupBy("_slice", *groups).agg(*[F.coalesce(F.sum(c), zero).alias(f"_{c}") for c in sums])
    offsets = slice_offsets(totals, [f"_{c}" for c in sums], groups, slices=slices).drop(*[f"_{c}" for c in sums])
    return _with_offsets(scanned, offsets, groups).select(
        *df.columns,
        *[(F.col(f"_{c}_before") + F.col(f"_{c}_inside")).alias(f"{c}_below") for c in sums],
        *[F.col(f"_{c}_total").alias(f"{c}_total") for c in sums])


def _slices(df: DataFrame, keys, slices: int | None) -> DataFrame:
    return df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)


def numbered_slices(df: DataFrame, keys, slices: int | None = None) -> DataFrame:
    """The rows in sorted slices of ``keys`` with ``_slice`` and ``_at``, which
    counts up along a slice; checkpointed, so that both stay with their rows."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = _slices(df, keys, slices).sortWithinPartitions(*keys)
    return ranged.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).checkpoint(eager=True)


def ranks_within(df: DataFrame, groups, order: list[Column], rank: str = "rank", slices: int | None = None) -> DataFrame:
    """Adds each row's 1-based place in its group by ``order``, as
    ``row_number`` over the group would, without a window over the group.

    Rows are ranged on (groups..., order), so a group that holds nearly all
    rows is spread over nearly all slices, and sorted inside the slice.  A
    running id numbers a slice's rows, which gives a row's place among its
    group's rows of the slice; the earlier slices' counts are added.  Rows move
    once.  Rows that ``order`` can't tell apart share a slice and are numbered
    in any order, like row_number does.  A null group is a group of its own.
    """
    groups = list(groups)
    ranged = numbered_slices(df, [*[F.col(g) for g in groups], *order], slices)
    totals = ranged.groupBy("_slice", *groups).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    offsets = slice_offsets(totals, ["_rows"], groups, slices=slices, in_total=False).drop("_rows")
    return _with_offsets(ranged, offsets, groups).select(
        *df.columns, (F.col("_rows_before") + F.col("_at") - F.col("_first") + 1).alias(rank))


def dense_codes(df: DataFrame, column: str, code: str | None = None, groups=()) -> DataFrame:
    """Alphabetical 0-based code of every distinct non-null value of ``column``
    (per group), as a (groups..., column, code) table."""
    code = code or f"{column}_code"
    levels = (df.select(*groups, column).filter(F.col(column).isNotNull()).distinct()
              .withColumn("_one", F.lit(1).cast("long")))
    ranked = prefix_sums(levels, column, ["_one"], groups)
    return ranked.select(*groups, column, F.col("_one_below").alias(code))
