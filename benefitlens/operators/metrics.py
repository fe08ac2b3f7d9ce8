"""Evaluation metrics as distributed aggregates.

The ranking metrics need, for every distinct score, the positives and
negatives strictly below it.  A single unpartitioned running sum would put
every distinct score in one task; ``prefix_sums`` does the scan over
range-partitioned slices instead and adds per-slice offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.operators.prefix import prefix_sums
from benefitlens.operators.ranking import rank_capacity


def _big(c):
    """Row counts multiply beyond 64 bits from a few billion rows on."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _auc_expr():
    """Rank-sum form, exact integers up to the final division; null without both classes."""
    twice_wins = F.sum(_big("pos") * (_big("neg_below") * 2 + _big("neg")))
    pairs = _big(F.sum(_big("pos"))) * _big(F.sum(_big("neg")))
    return F.try_divide(twice_wins.cast("double"), pairs.cast("double") * 2).alias("roc_auc")


def _average_precision_expr():
    """Recall steps times precision; null without positives."""
    tp = (F.col("pos_total") - F.col("pos_below")).cast("double")
    fp = (F.col("neg_total") - F.col("neg_below")).cast("double")
    step = F.try_divide(F.col("pos").cast("double"), F.col("pos_total").cast("double"))
    return F.sum(step * F.try_divide(tp, tp + fp)).alias("average_precision")


def score_histogram(df: DataFrame, score: str = "p", label: str = "enrolled", groups=()) -> DataFrame:
    """Per (group, distinct score): positives and negatives (combined map-side)."""
    y = F.col(label).cast("bigint")
    return (df.filter(F.col(score).isNotNull())
            .groupBy(*groups, F.col(score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def score_cumulative(df: DataFrame, score: str = "p", label: str = "enrolled",
                     groups=()) -> DataFrame:
    """Per (group, distinct score): pos, neg, pos_below and neg_below, where
    "below" counts rows of the same group with a strictly lower score, plus
    the group's pos_total and neg_total.

    The histogram has one row per distinct score (a hot score is one row);
    its running sums come from the distributed scan in ``prefix_sums``, so no
    task ever holds all distinct scores of a group.
    """
    hist = score_histogram(df, score, label, list(groups))
    return prefix_sums(hist, "score", ["pos", "neg"], list(groups))


def auc_from_cumulative(c: DataFrame, groups=()) -> DataFrame:
    return c.groupBy(*groups).agg(
        _auc_expr(), F.sum("pos").cast("bigint").alias("n_pos"), F.sum("neg").cast("bigint").alias("n_neg"))


def auc(df: DataFrame, score: str = "p", label: str = "enrolled", groups=()) -> DataFrame:
    """Exact ROC-AUC with ties counted one half (rank-sum form), per group.

    Integer sums until the final division, so the value is reproducible.
    """
    return auc_from_cumulative(score_cumulative(df, score, label, groups), groups)


def average_precision(df: DataFrame, score: str = "p", label: str = "enrolled") -> DataFrame:
    """Step-wise average precision (sum of recall steps x precision at
    each distinct threshold, scores at or above it count as positive)."""
    return score_cumulative(df, score, label).agg(_average_precision_expr())


def ranking_metrics(df: DataFrame, score: str = "p", label: str = "enrolled", groups=()) -> DataFrame:
    """M12 and M13 from one scan: exact ROC-AUC and step-wise average precision."""
    return score_cumulative(df, score, label, groups).groupBy(*groups).agg(_auc_expr(), _average_precision_expr())


def _count_exprs(score: str, label: str, threshold: float):
    pred = (F.col(score) >= F.lit(threshold)).cast("int")
    y = F.col(label).cast("int")
    return [F.count_if((pred == 1) & (y == 1)).cast("bigint").alias("tp"),
            F.count_if((pred == 1) & (y == 0)).cast("bigint").alias("fp"),
            F.count_if((pred == 0) & (y == 1)).cast("bigint").alias("fn"),
            F.count_if((pred == 0) & (y == 0)).cast("bigint").alias("tn")]


def _counts(df: DataFrame, score: str, label: str, threshold: float):
    return df.agg(*_count_exprs(score, label, threshold))


def _with_rates(c: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return c.withColumns({"accuracy": F.try_divide(tp + tn, tp + fp + fn + tn), "precision": prec, "recall": rec,
                          "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))})


def threshold_metrics(df: DataFrame, score: str = "p", label: str = "enrolled",
                      threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 at ``score >= threshold``."""
    return _with_rates(_counts(df, score, label, threshold)).select(
        "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1")


def _brier_expr(score: str, label: str):
    return F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier")


def _log_loss_expr(score: str, label: str, eps: float = 1e-15):
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss")


def brier(df: DataFrame, score: str = "p", label: str = "enrolled") -> DataFrame:
    """M15."""
    return df.agg(_brier_expr(score, label))


def log_loss(df: DataFrame, score: str = "p", label: str = "enrolled", eps: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood with probabilities clipped to [eps, 1-eps]."""
    return df.agg(_log_loss_expr(score, label, eps))


def pointwise_metrics(df: DataFrame, score: str = "p", label: str = "enrolled",
                      threshold: float = 0.5) -> DataFrame:
    """M14-M16 in one aggregate pass: threshold metrics, Brier and log loss."""
    c = df.agg(*_count_exprs(score, label, threshold), _brier_expr(score, label),
               _log_loss_expr(score, label))
    return _with_rates(c).select("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1",
                                 "brier", "log_loss")


def confusion_matrix(df: DataFrame, score: str = "p", label: str = "enrolled",
                     threshold: float = 0.5) -> DataFrame:
    """Actual x predicted counts, zero-filled."""
    pred = (F.col(score) >= F.lit(threshold)).cast("int").alias("predicted")
    p = (df.select(F.col(label).cast("int").alias("actual"), pred)
         .groupBy("actual").pivot("predicted", [0, 1]).agg(F.count(F.lit(1))))
    return p.select("actual", F.coalesce(F.col("0"), F.lit(0)).cast("bigint").alias("pred_0"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("bigint").alias("pred_1"))


def classification_report(df: DataFrame, score: str = "p", label: str = "enrolled",
                          threshold: float = 0.5) -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted rows."""
    c = _counts(df, score, label, threshold)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def row(name, tp_, fp_, fn_, sup):
        prec = F.coalesce(F.try_divide(tp_, tp_ + fp_), F.lit(0.0))
        rec = F.coalesce(F.try_divide(tp_, tp_ + fn_), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * tp_, 2 * tp_ + fp_ + fn_), F.lit(0.0))
        return F.struct(F.lit(name).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), sup.alias("support"))

    r1 = row("1", tp, fp, fn, tp + fn)
    r0 = row("0", tn, fn, fp, tn + fp)
    base = c.select(r0.alias("r0"), r1.alias("r1"))
    n = F.col("r0.support") + F.col("r1.support")
    macro = F.struct(F.lit("macro avg").alias("label"),
                     *[((F.col(f"r0.{m}") + F.col(f"r1.{m}")) / 2).alias(m) for m in ("precision", "recall", "f1")],
                     n.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("label"),
                        *[F.try_divide(F.col(f"r0.{m}") * F.col("r0.support") + F.col(f"r1.{m}") * F.col("r1.support"), n).alias(m)
                          for m in ("precision", "recall", "f1")],
                        n.alias("support"))
    out = base.select(F.explode(F.array(F.col("r0"), F.col("r1"), macro, weighted)).alias("r"))
    return out.select("r.label", "r.precision", "r.recall", "r.f1",
                      F.col("r.support").cast("bigint").alias("support"))


def calibration_bins(df: DataFrame, score: str = "p", label: str = "enrolled", n_bins: int = 10) -> DataFrame:
    """Reliability table by ``floor(p * n_bins)`` (p = 1 joins the top bin)."""
    b = F.least(F.floor(F.col(score) * n_bins), F.lit(n_bins - 1)).cast("int")
    return (df.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(score).alias("mean_p"),
                 F.avg(F.col(label).cast("double")).alias("observed_rate")))


def naive_baselines(df: DataFrame, label: str = "enrolled", rule: str = "has_dependents_bin") -> DataFrame:
    """Majority-class accuracy and a 0/1 one-rule baseline (accuracy, AUC).

    For a 0/1 score the exact AUC follows from the four confusion counts:
    (tp*tn + (tp*fp + fn*tn)/2) / (P*N), so one aggregate pass suffices.
    """
    s, y = F.col(rule).cast("int"), F.col(label).cast("int")
    c = df.agg(F.count_if((s == 1) & (y == 1)).alias("tp"), F.count_if((s == 1) & (y == 0)).alias("fp"),
               F.count_if((s == 0) & (y == 1)).alias("fn"), F.count_if((s == 0) & (y == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    pos_rate = F.try_divide(tp + fn, n)
    return c.select(
        F.greatest(pos_rate, 1 - pos_rate).alias("majority_accuracy"),
        F.try_divide(tp + tn, n).alias("rule_accuracy"),
        F.try_divide(tp * tn + (tp * fp + fn * tn) / 2, (tp + fn) * (fp + tn)).alias("rule_auc"))


def precision_lift_at_k(scored: DataFrame, regions: DataFrame, score: str = "p",
                        label: str = "enrolled") -> DataFrame:
    """Per region, precision of the top K = round(capacity / 5) and its lift
    over the region's base rate."""
    caps = regions.withColumn("hr_outreach_capacity",
                              F.round(F.col("hr_outreach_capacity") / 5.0).cast("int"))
    # a region without a capacity has no K: it keeps its base rate and no precision
    known = caps.filter(F.col("hr_outreach_capacity").isNotNull()).select("region")
    top = rank_capacity(scored.join(known, "region", "left_semi"), caps, top_k=None, score=score)
    prec = top.groupBy("region").agg(F.count(F.lit(1)).cast("bigint").alias("k"),
                                     F.avg(F.col(label).cast("double")).alias("precision_at_k"))
    base = scored.groupBy("region").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                        F.avg(F.col(label).cast("double")).alias("base_rate"))
    # Both sides are aggregates already hash-partitioned on region, so the
    # join adds no exchange; sizing ``prec`` for a broadcast would run the
    # whole ranking once more just to count it.
    return (base.join(prec, "region", "left")
            .withColumn("lift_at_k", F.try_divide(F.col("precision_at_k"), F.col("base_rate"))))
