"""Sorting and top-K reports, including per-region capacity caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benefitlens.operators.joins import BROADCAST_MAX_ROWS, broadcast_if_small
from benefitlens.operators.prefix import ranks_within


def _order(score: str, ascending: bool, tiebreak: str) -> list[Column]:
    s = F.col(score).asc() if ascending else F.col(score).desc()
    return [s, F.col(tiebreak).asc()]


def sort_scores(df: DataFrame, score="p", ascending=False, tiebreak="employee_id") -> DataFrame:
    """Total order by score then id (range-partitioned sort, no single task)."""
    return df.orderBy(*_order(score, ascending, tiebreak))


def rank_topk(df: DataFrame, k: int, score="p", ascending=False,
              tiebreak="employee_id") -> DataFrame:
    """The k best rows with rank numbers 1..k.

    ``orderBy().limit(k)`` plans TakeOrderedAndProject: every task keeps its
    own k best, so only k rows per task reach the final merge.  The rank is
    then numbered on those k rows only.
    """
    top = df.orderBy(*_order(score, ascending, tiebreak)).limit(k)
    w = Window.orderBy(*_order(score, ascending, tiebreak))
    return top.withColumn("rank", F.row_number().over(w))


def _best_per_region(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Rows ranked up to ``k`` in their region.

    Up to the session's window-group limit Spark keeps only k rows a region in
    every map task.  Beyond it the rows are ranked by the distributed scan, so
    no task sorts a whole hot region.
    """
    limit = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        return _ranked(scored, order).filter(F.col("rank") <= F.lit(k))
    w = Window.partitionBy("region").orderBy(*order)
    return scored.select("*", F.row_number().over(w).alias("rank")).filter(F.col("rank") <= F.lit(k))


def _ranked(scored: DataFrame, order: list[Column]) -> DataFrame:
    """All rows with their rank in their region, whatever a region's share of them."""
    return ranks_within(scored, ["region"], order)


def filter_ci(df: DataFrame, column: str, value: str) -> DataFrame:
    """PF5: case-insensitive equality filter."""
    return df.filter(F.lower(F.col(column)) == F.lit(value.lower()))


def filter_ci_status(df: DataFrame, column: str, values) -> DataFrame:
    """PF5's outcome per requested value: how many rows match, and ``no_match``
    where none does, so an empty answer isn't mistaken for a valid one."""
    # the requests come from the caller, so their number is known
    wanted = df.sparkSession.createDataFrame([(v, v.lower()) for v in values], "requested string, _key string")
    counts = df.groupBy(F.lower(F.col(column)).alias("_key")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return (wanted.join(counts, "_key", "left")
            .select("requested", n.alias("n_matches"), F.when(n > 0, F.lit("ok")).otherwise(F.lit("no_match")).alias("status")))


def rank_capacity(scored: DataFrame, regions: DataFrame, top_k: int | None = None,
                  score="p", ascending=False, tiebreak="employee_id",
                  region_filter: str | None = None,
                  employment_type: str | None = None) -> DataFrame:
    """Per-region ranking capped at ``min(top_k, hr_outreach_capacity)``.

    ``top_k=None`` means "use the capacity".  A region without a capacity (no
    row, or a null one) is cut at ``top_k``, and not at all when no ``top_k``
    is given.  All capped regions are ranked in one job.
    Regions are few and skewed, so the rank is first cut at the largest
    possible K (a literal from the small dimension): Spark then plans a
    WindowGroupLimit that keeps only that many rows per region in every map
    task before the shuffle, and the hot region never lands whole in one task.
    Regions without a limit are ranked by the distributed scan of ``prefix``.
    """
    if region_filter is not None:
        scored = filter_ci(scored, "region", region_filter)
    if employment_type is not None:
        scored = filter_ci(scored, "employment_type", employment_type)
    order = _order(score, ascending, tiebreak)
    cap = F.col("hr_outreach_capacity").cast("int")
    k_eff = cap if top_k is None else F.least(cap, F.lit(int(top_k)))
    caps = regions.select("region", cap.alias("capacity"), k_eff.alias("k_eff"))
    # one small job on the dimension: the largest cap and the row count
    stats = caps.agg(F.max("k_eff").alias("k"), F.count(F.lit(1)).alias("n"), F.count("k_eff").alias("known")).first()
    side = F.broadcast if stats["n"] <= BROADCAST_MAX_ROWS else (lambda d: d)
    if top_k is not None:
        ranked = _best_per_region(scored, max(int(stats["k"] or 0), int(top_k)), order)
        return (ranked.join(side(caps), "region", "left")
                .filter(F.col("rank") <= F.coalesce(F.col("k_eff"), F.lit(int(top_k)))).drop("k_eff"))
    known = caps.filter(F.col("k_eff").isNotNull())
    capped = _best_per_region(scored.join(side(known.select("region")), "region", "left_semi"), int(stats["k"] or 0), order)
    capped = capped.join(side(known), "region").filter(F.col("rank") <= F.col("k_eff")).drop("k_eff")
    uncapped = scored.join(side(known.select("region")), "region", "left_anti")
    uncapped = _ranked(uncapped, order).withColumn("capacity", F.lit(None).cast("int"))
    return capped.unionByName(uncapped)


def rank_summary(scored: DataFrame, regions: DataFrame, top_k: int | None = None) -> DataFrame:
    """Eligible rows, returned rows and the applied cap, per region."""
    caps = regions.select("region", F.col("hr_outreach_capacity").cast("int").alias("capacity"))
    k_eff = F.col("capacity") if top_k is None else F.least(F.col("capacity"), F.lit(int(top_k)))
    counts = scored.groupBy("region").agg(F.count(F.lit(1)).cast("bigint").alias("total_eligible"))
    j = counts.join(broadcast_if_small(caps), "region", "left")
    return j.select("region", "total_eligible", k_eff.alias("hr_capacity_cap_applied"),
                    F.least(F.col("total_eligible"), k_eff.cast("bigint"), F.lit(top_k).cast("bigint"))
                    .alias("returned_count"))


def region_profile_lookup(regions: DataFrame, region: str | None = None) -> DataFrame:
    """One region (case-insensitive) or all, as attribute/value rows."""
    df = regions if region is None else filter_ci(regions, "region", region)
    attrs = [c for c in df.columns if c != "region"]
    as_text = df.select("region", *[F.col(c).cast("string").alias(c) for c in attrs])
    return as_text.unpivot(["region"], attrs, "attribute", "value")


def ranking_rows(ranked: DataFrame, raw: DataFrame, score: str = "p", threshold: float = 0.5) -> DataFrame:
    """The outreach ranking row: rank, id, attributes, clean tier/channel
    (also under the raw names, which carry clean values in the reference's
    rows), probability rounded to 4 places and the class at ``threshold``.

    ``age`` is left out of outreach rows (protected; audits join it by key).
    """
    from benefitlens.constants import CHANNEL_MAP, TIER_MAP
    from benefitlens.functions.canon import lookup_trim_retry
    attrs = raw.select("employee_id", "salary",
                       lookup_trim_retry("plan_tier_requested", TIER_MAP).alias("plan_tier_requested_clean"),
                       lookup_trim_retry("last_contact_channel", CHANNEL_MAP).alias("last_contact_channel_clean"))
    j = ranked.join(attrs, "employee_id", "left")
    return j.select(
        "rank", "employee_id", "salary", "region", "employment_type",
        "plan_tier_requested_clean", "last_contact_channel_clean",
        F.col("plan_tier_requested_clean").alias("plan_tier_requested"),
        F.col("last_contact_channel_clean").alias("last_contact_channel"),
        F.round(F.col(score), 4).alias("enrollment_probability"),
        (F.col(score) >= threshold).cast("int").alias("predicted_enrolled"))
