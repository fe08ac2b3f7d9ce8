"""Exact, linearly interpolated quantiles (pandas/numpy 'linear') at scale.

Spark's exact ``percentile`` merges a map of every distinct value of a group
in one task, and a histogram of a nearly unique column is as large as the
column.  Here a small sketch says where to look, and only that is looked at:

1. **Sketch.**  One pass makes each group's row count, least and greatest value
   and approximate quantiles on both sides of each wanted position.  They
   bracket the position, about ``4 / ACCURACY`` of the group's rows wide.
2. **Check.**  One pass counts the rows below and inside each bracket (a few
   numbers a group, combined map-side).  A bracket that misses its position,
   which a sketch may do, is replaced by the group's whole range.
3. **Pick.**  Only values inside a bracket are reduced to a histogram (one row
   per distinct value) and scanned by ``prefix_sums``; each histogram row checks
   whether it covers the positions floor(h) or floor(h)+1 of h = (n - 1) * q.

The result is exact whatever the sketch says; the sketch only bounds what is
shuffled.  Groups of at most ``WHOLE`` rows take their whole range at once, and
if there are no others, the passes 1 and 2 have nothing to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.operators.joins import broadcast_if_small
from benefitlens.operators.prefix import prefix_sums
from benefitlens.session import ensure_checkpoint_dir

#: Sketch accuracy: its quantiles are off by at most 1 / ACCURACY of a group's rows.
ACCURACY = 1_000
#: A group of at most so many rows is histogrammed whole.
WHOLE = 20 * ACCURACY
#: Groups whose brackets may be broadcast; with more, they are joined by key.
BROADCAST_GROUPS = 100_000
#: Number of the bracket that is a group's whole range and serves all of its positions.
WHOLE_RANGE = -1


def exact_quantiles(df: DataFrame, value: str, probs, groups=(), accuracy: int = ACCURACY, whole: int = WHOLE) -> DataFrame:
    """One row per (groups..., prob) with the interpolated quantile ``value``.

    Null values are left out, a group without values has no rows; a null group
    is a group of its own.  ``accuracy`` and ``whole`` steer the work only.
    """
    groups, probs = list(groups), [float(q) for q in probs]
    if not groups:
        return exact_quantiles(df.withColumn("_k", F.lit(0)), value, probs, ["_k"], accuracy, whole).drop("_k")
    ensure_checkpoint_dir(df.sparkSession)
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull()).select(*groups, v.alias("_v"))
    sketch = _sketch(rows, probs, groups, accuracy)
    if sketch.filter(F.col("_n") > whole).isEmpty():
        hist = rows.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c"))
        scanned = prefix_sums(hist, "_v", ["_c"], groups)
        scanned = scanned.withColumns({"_n": F.col("_c_total"), "_at": F.lit(WHOLE_RANGE), "_before": F.lit(0).cast("bigint")})
    else:
        scanned = prefix_sums(bracketed_histogram(rows, probs, groups, sketch, whole), "_v", ["_c"], [*groups, "_at"])
    return _interpolated(_picked(scanned, probs, groups), groups)


def _sketch(rows: DataFrame, probs, groups, accuracy: int) -> DataFrame:
    """One row per group: rows, range, and values around each position."""
    margin = 2.0 / accuracy
    ends = [(max(q - margin, 0.0), min(q + margin, 1.0)) for q in probs]
    around = F.percentile_approx("_v", [p for both in ends for p in both], accuracy)
    sketch = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), around.alias("_s"))
    brackets = [F.struct(F.lit(i).alias("at"),
                         (F.col("_least") if lo <= 0 else F.col("_s")[2 * i]).alias("lo"),
                         (F.col("_most") if hi >= 1 else F.col("_s")[2 * i + 1]).alias("hi")) for i, (lo, hi) in enumerate(ends)]
    return sketch.select(*groups, "_n", "_least", "_most", F.array(*brackets).alias("_brackets")).checkpoint(eager=True)


def _of_group(rows: DataFrame, per_group: DataFrame, groups) -> DataFrame:
    """The rows of the groups in ``per_group`` (one row a group) with its columns."""
    side = per_group.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(groups)})
    side = broadcast_if_small(side, BROADCAST_GROUPS)
    return rows.join(side, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])


def _position(q: float):
    """(h, floor(h), the next position) of a probability in ``_n`` sorted rows."""
    h = (F.col("_n") - 1).cast("double") * F.lit(q)
    k0 = F.floor(h)
    return h, k0, F.least(k0 + 1, F.col("_n") - 1)


def bracketed_histogram(rows: DataFrame, probs, groups, sketch: DataFrame, whole: int) -> DataFrame:
    """groups, ``_at`` (bracket), ``_v``, ``_c`` (rows with that value), ``_n``
    (the group's rows) and ``_before`` (its rows below the bracket) of the
    values inside a bracket."""
    large = sketch.filter(F.col("_n") > whole)
    bracket = lambda i, c: F.col("_brackets")[i][c]
    counts = _of_group(rows, large.select(*groups, "_brackets"), groups).groupBy(*groups).agg(
        *[F.count_if(F.col("_v") < bracket(i, "lo")).alias(f"_below{i}") for i in range(len(probs))],
        *[F.count_if(F.col("_v") <= bracket(i, "hi")).alias(f"_upto{i}") for i in range(len(probs))])
    known = _of_group(counts, large, groups)
    chosen = []
    for i, q in enumerate(probs):
        _, k0, k1 = _position(q)
        holds = (F.col(f"_below{i}") <= k0) & (F.col(f"_upto{i}") > k1)
        chosen.append(F.struct(
            F.lit(i).alias("at"), F.when(holds, bracket(i, "lo")).otherwise(F.col("_least")).alias("lo"),
            F.when(holds, bracket(i, "hi")).otherwise(F.col("_most")).alias("hi"),
            F.when(holds, F.col(f"_below{i}")).otherwise(F.lit(0)).cast("bigint").alias("before")))
    small = sketch.filter(F.col("_n") <= whole)
    all_of_it = F.struct(F.lit(WHOLE_RANGE).alias("at"), F.col("_least").alias("lo"), F.col("_most").alias("hi"),
                         F.lit(0).cast("bigint").alias("before"))
    checked = known.select(*groups, "_n", F.array(*chosen).alias("_b")).unionByName(
        small.select(*groups, "_n", F.array(all_of_it).alias("_b"))).checkpoint(eager=True)
    inside = F.filter("_b", lambda b: (F.col("_v") >= b["lo"]) & (F.col("_v") <= b["hi"]))
    kept = _of_group(rows, checked, groups).select(*groups, "_v", "_n", F.explode(inside).alias("_i"))
    return (kept.groupBy(*groups, F.col("_i.at").alias("_at"), "_v", "_n", F.col("_i.before").alias("_before"))
            .agg(F.count(F.lit(1)).alias("_c")))


def _picked(scanned: DataFrame, probs, groups) -> DataFrame:
    """The histogram rows that cover a position, as (groups..., _v, _p)."""
    low = F.col("_before") + F.col("_c_below")
    picks = []
    for i, q in enumerate(probs):
        h, k0, k1 = _position(q)
        mine = F.col("_at").isin(WHOLE_RANGE, i)
        for which, k in (("lo", k0), ("hi", k1)):
            picks.append(F.when(mine & (low <= k) & (k < low + F.col("_c")),
                                F.struct(F.lit(q).alias("prob"), F.lit(which).alias("which"), (h - k0).alias("frac"))))
    return scanned.select(*groups, "_v", F.explode(F.filter(F.array(*picks), lambda x: x.isNotNull())).alias("_p"))


def _interpolated(hits: DataFrame, groups) -> DataFrame:
    g = hits.groupBy(*groups, F.col("_p.prob").alias("prob")).agg(
        F.max(F.when(F.col("_p.which") == "lo", F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_p.which") == "hi", F.col("_v"))).alias("_hi"),
        F.max("_p.frac").alias("_f"))
    return g.select(*groups, "prob",
                    (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("value"))


def quartile_columns(df: DataFrame, value: str, groups=()) -> DataFrame:
    """q25/q50/q75 side by side per group (for describe-style reports)."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], groups)
    return q.groupBy(*groups).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                    for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
