"""Most frequent values and cardinality of wide text columns.

Counting every value of a nearly unique column shuffles the column.  Here a
count-min sketch (a few rows of counters by a hash of the value, added up
map-side) gives every value an upper bound of its count; the exact counts of
some promising values give a lower bound of the k-th largest count.  Only
values whose upper bound reaches that are counted one by one, so the answer is
exact, ties included, and rare values are dropped before the shuffle.

Distinct counts come from HyperLogLog sketches (``approx_count_distinct``) with
the stated relative standard deviation, or exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benefitlens.session import ensure_checkpoint_dir

#: Rows and counters a row of a column's count-min sketch.
SKETCH_ROWS, COUNTERS = 3, 1024
#: Rows (about) that promising values are looked for in.
PROBED = 200_000


def _long(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], [f"`{c}`" for c in columns], "column_name", "value")


def _counter(row):
    return F.pmod(F.xxhash64("value", row), F.lit(COUNTERS)).cast("int")


def count_min(long: DataFrame) -> DataFrame:
    """One row per column: its sketch as ``SKETCH_ROWS`` arrays of counters."""
    hit = long.select("column_name", F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _counter(F.lit(j)).alias("b")) for j in range(SKETCH_ROWS)])).alias("c"))
    # at most SKETCH_ROWS x COUNTERS rows a column leave each map task
    counts = hit.groupBy("column_name", "c.j", "c.b").agg(F.count(F.lit(1)).alias("n"))
    lists = counts.groupBy("column_name").agg(*[F.map_from_entries(F.collect_list(F.when(F.col("j") == j, F.struct("b", "n")))).alias(f"m{j}") for j in range(SKETCH_ROWS)])
    full = lambda m: F.transform(F.sequence(F.lit(0), F.lit(COUNTERS - 1)), lambda b: F.coalesce(F.try_element_at(m, b), F.lit(0)))
    return lists.select("column_name", *[full(F.col(f"m{j}")).alias(f"s{j}") for j in range(SKETCH_ROWS)])


def _ranked(counts: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def candidates(long: DataFrame, top: int) -> DataFrame:
    """The rows of ``long`` whose value may be among its column's ``top`` most frequent."""
    ensure_checkpoint_dir(long.sparkSession)
    n = long.count()
    probed = long.sample(min(1.0, PROBED / max(n, 1)), seed=7)
    promising = _ranked(probed.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")), top).select(
        F.col("column_name").alias("_c"), F.col("value").alias("_v")).checkpoint(eager=True)
    same = (F.col("column_name") == F.col("_c")) & F.col("value").eqNullSafe(F.col("_v"))
    known = long.join(F.broadcast(promising), same).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    # the least of ``top`` exact counts bounds the top-th largest from below; with fewer there's no bound
    least = known.groupBy("column_name").agg(F.when(F.count(F.lit(1)) >= top, F.min("count")).alias("least"))
    # a row for each column, so as wide as the table's header
    side = F.broadcast(count_min(long).join(least, "column_name", "left").withColumnRenamed("column_name", "_c").checkpoint(eager=True))
    bound = F.array_min(F.array(*[F.get(f"s{j}", _counter(F.lit(j))) for j in range(SKETCH_ROWS)]))
    return long.join(side, F.col("column_name") == F.col("_c")).filter(bound >= F.coalesce("least", F.lit(0))).select("column_name", "value")


def top_values(df: DataFrame, columns, top: int = 5) -> DataFrame:
    """The ``top`` most frequent values of each column (null is a value), exactly: column_name, value, count, rank.

    Ties are ordered by the value, nulls first.
    """
    long = _long(df, columns)
    counts = candidates(long, top).groupBy("column_name", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    return _ranked(counts, top)


def approx_cardinality(df: DataFrame, columns, rsd: float = 0.01) -> DataFrame:
    """column_name, n_unique (not null, estimated), relative_sd: one pass with a sketch of fixed size per column."""
    agg = df.agg(*[F.approx_count_distinct(f"`{c}`", rsd).cast("bigint").alias(c) for c in columns])
    return agg.unpivot([], [f"`{c}`" for c in columns], "column_name", "n_unique").withColumn("relative_sd", F.lit(float(rsd)))
