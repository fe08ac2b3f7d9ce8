"""Leakage, fairness, refusal and explanation jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benefitlens.constants import (DISCRIMINATION_PATTERNS, DISCRIMINATION_REFUSAL_MESSAGE,
                                   HIGH_COVERAGE_TIERS, LEAKAGE_REFUSAL_MESSAGE, LEAKY_COLUMN,
                                   MEDICAL_KEYWORDS, MEDICAL_REFUSAL_MESSAGE, PROTECTED_ATTRIBUTES,
                                   REASON_DEPENDENTS_NO, REASON_DEPENDENTS_YES, REASON_FULL_TIME,
                                   REASON_HIGH_TIER, REASON_OTHER_TYPE, REASON_PRIOR_NO,
                                   REASON_PRIOR_YES, REASON_SALARY_HIGH, REASON_SALARY_LOW,
                                   SALARY_THRESHOLD)
from benefitlens.functions.flags import age_band
from benefitlens.functions.text import any_pattern, py_strip, word_boundary_alternation
from benefitlens.operators.metrics import auc_from_cumulative, score_cumulative
from benefitlens.operators.profile import safe_corr


# ----------------------------------------------------------------- L1 / L2 leakage
def leakage_screen(df: DataFrame, columns, label: str = "enrolled", threshold: float = 0.9) -> DataFrame:
    """L1 for every column at once: class means and gap, correlation, solo AUC
    (on rows where the column is present), accuracy of ``value >= 0.5`` and a
    verdict at ``corr > threshold``.

    The columns are unpivoted once; the AUC is the exact per-score rank-sum,
    grouped by column.
    """
    cols = list(columns)
    long = (df.select(F.col(label).cast("int").alias("_y"),
                      *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(["_y"], cols, "column_name", "_v")
            .filter(F.col("_v").isNotNull()))
    stats = long.groupBy("column_name").agg(
        F.avg(F.when(F.col("_y") == 0, F.col("_v"))).alias("mean_neg"),
        F.avg(F.when(F.col("_y") == 1, F.col("_v"))).alias("mean_pos"),
        safe_corr(F.col("_v"), F.col("_y")).alias("corr"),
        F.avg(((F.col("_v") >= 0.5).cast("int") == F.col("_y")).cast("double")).alias("threshold_accuracy"),
        F.count(F.lit(1)).cast("bigint").alias("n"))
    aucs = _grouped_auc(long)
    return (stats.join(aucs, "column_name", "left")
            .withColumn("gap", F.col("mean_pos") - F.col("mean_neg"))
            .withColumn("verdict", F.when(F.col("corr") > threshold, F.lit("LEAKY"))
                        .otherwise(F.lit("REVIEW"))))


def _grouped_auc(long: DataFrame) -> DataFrame:
    """Exact AUC of ``_v`` against ``_y`` per ``column_name`` (two-level prefix sums)."""
    c = score_cumulative(long, "_v", "_y", groups=["column_name"])
    return auc_from_cumulative(c, ["column_name"]).select("column_name", F.col("roc_auc").alias("solo_auc"))


def leakage_aggregate(engineered: DataFrame, split_df: DataFrame, by: str = "region",
                      column: str = "hist_enrollment_rate_region", label: str = "enrolled") -> DataFrame:
    """L2: published vs actual rate per region, and the column's correlation
    and AUC (test side of the split) repeated on every row."""
    per = (engineered.groupBy(by)
           .agg(F.avg(F.col(label).cast("double")).alias("actual_rate"),
                F.min(column).alias("published_rate")))
    overall = engineered.agg(safe_corr(F.col(column), F.col(label)).alias("corr"),
                             F.avg(F.col(label).cast("double")).alias("overall_rate"))
    test = split_df.filter(F.col("split") == "test").select(
        F.coalesce(F.col(column), F.lit(0.0)).alias("s"), label)
    auc = auc_from_cumulative(score_cumulative(test, "s", label)).select(F.col("roc_auc").alias("test_auc"))
    o = overall.first()
    a = auc.first()
    return (per.withColumn("diff", F.abs(F.col("actual_rate") - F.col("published_rate")))
               .withColumn("corr", F.lit(o["corr"]).cast("double"))
               .withColumn("overall_rate", F.lit(o["overall_rate"]).cast("double"))
               .withColumn("test_auc", F.lit(a["test_auc"]).cast("double")))


# ----------------------------------------------------------------- L3 refusal
def table_has_leak(df: DataFrame) -> bool:
    """Plan-time check: a scoring input holding the leaky column is refused."""
    return LEAKY_COLUMN in df.columns


def refuse_leakage(requests: DataFrame) -> DataFrame:
    """L3 on a request table ``(request_id, employee_id, feature_requested)``:
    requests naming the leaky feature (any case, as a substring) become
    refusal rows; the rest are marked to be scored."""
    hit = F.lower(F.col("feature_requested")).contains(LEAKY_COLUMN)
    refused = F.coalesce(hit, F.lit(False))
    return requests.select(
        "*",
        F.when(refused, F.lit("refusal")).otherwise(F.lit("ok")).alias("status"),
        F.when(refused, F.lit("TARGET_LEAKAGE_REFUSAL")).alias("refusal_type"),
        F.when(refused, F.lit(LEAKAGE_REFUSAL_MESSAGE)).alias("message"))


# ----------------------------------------------------------------- L6-L8 explanations
def _fmt_money(c: Column) -> Column:
    return F.format_number(c, 2)


def reason_codes(raw: DataFrame) -> DataFrame:
    """L6 + L7: rule-based reason codes from the RAW record, as an array of
    ``struct(feature, effect, reasoning)``; protected attributes are filtered
    out of the array itself.

    These rules are fixed thresholds, independent of any model: a missing
    salary counts as 60,000; the tier test title-cases the stripped raw tier.
    """
    has_dep = F.coalesce(py_strip(F.col("has_dependents")) == "Yes", F.lit(False))
    salary = F.coalesce(F.col("salary").cast("double"), F.lit(SALARY_THRESHOLD))
    emp = F.col("employment_type")
    prior = F.coalesce(F.col("prior_year_enrolled").cast("int"), F.lit(-1))
    tier_title = F.initcap(F.lower(py_strip(F.col("plan_tier_requested"))))
    tier_word = F.lower(py_strip(F.col("plan_tier_requested")))

    def d(feature, effect, reasoning):
        return F.struct(F.lit(feature).alias("feature"), F.lit(effect).alias("effect"),
                        reasoning.alias("reasoning"))

    money = _fmt_money(salary)
    drivers = F.array(
        F.when(has_dep, d("has_dependents", "Positive", F.lit(REASON_DEPENDENTS_YES)))
         .otherwise(d("has_dependents", "Negative", F.lit(REASON_DEPENDENTS_NO))),
        F.when(salary >= SALARY_THRESHOLD,
               d("salary", "Positive", F.format_string(REASON_SALARY_HIGH.replace("{}", "%s"), money)))
         .otherwise(d("salary", "Negative", F.format_string(REASON_SALARY_LOW.replace("{}", "%s"), money))),
        F.when(emp == "Full-time", d("employment_type", "Positive", F.lit(REASON_FULL_TIME)))
         .when(emp.isin("Part-time", "Contract"),
               d("employment_type", "Negative", F.format_string(REASON_OTHER_TYPE.replace("{}", "%s"), emp))),
        F.when(prior == 1, d("prior_year_enrolled", "Positive", F.lit(REASON_PRIOR_YES)))
         .when(prior == 0, d("prior_year_enrolled", "Negative", F.lit(REASON_PRIOR_NO))),
        # a one-word tier title-cases to a high-coverage name only when its
        # lower-case form is that name; compare on the lower-case form
        F.when(tier_word.isin(*[t.lower() for t in HIGH_COVERAGE_TIERS]),
               d("plan_tier_requested", "Positive",
                 F.format_string(REASON_HIGH_TIER.replace("{}", "%s"), tier_title))),
    )
    protected = F.array(*[F.lit(p) for p in PROTECTED_ATTRIBUTES])
    kept = F.filter(drivers, lambda x: x.isNotNull() & ~F.array_contains(protected, x["feature"]))
    return raw.withColumn("top_drivers", kept)


def narrative(prob: Column, employee_id: Column) -> Column:
    """One sentence with the direction and the probability as a percentage."""
    direction = F.when(prob >= 0.5, F.lit("highly likely to enroll")).otherwise(F.lit("unlikely to enroll"))
    who = F.when(employee_id.isNotNull(), F.concat(F.lit("Employee "), employee_id.cast("bigint").cast("string"))) \
           .otherwise(F.lit("This employee"))
    pct = F.concat(F.format_number(prob * 100, 2), F.lit("%"))
    return F.concat(who, F.lit(" is predicted as "), direction,
                    F.lit(" with an estimated enrollment probability of "), pct, F.lit("."))


# ----------------------------------------------------------------- L9 prompt screening
MEDICAL_RE = word_boundary_alternation(MEDICAL_KEYWORDS)
DISCRIMINATION_RE = any_pattern(DISCRIMINATION_PATTERNS)


def screen_prompts(df: DataFrame, text: str = "text") -> DataFrame:
    """L9 over a prompt table: medical terms first, then discrimination
    patterns; the first hit decides.  Blank or missing text is allowed."""
    t = F.lower(F.col(text))
    blank = F.col(text).isNull() | (py_strip(F.col(text)) == "")
    rtype = (F.when(blank, F.lit(None))
             .when(t.rlike(MEDICAL_RE), F.lit("MEDICAL_ADVICE_REFUSAL"))
             .when(t.rlike(DISCRIMINATION_RE), F.lit("DISCRIMINATION_GUARDRAIL_REFUSAL")))
    msg = (F.when(rtype == "MEDICAL_ADVICE_REFUSAL", F.lit(MEDICAL_REFUSAL_MESSAGE))
           .when(rtype == "DISCRIMINATION_GUARDRAIL_REFUSAL", F.lit(DISCRIMINATION_REFUSAL_MESSAGE)))
    return df.withColumns({"refusal_type": rtype, "allowed": rtype.isNull(), "refusal_message": msg})


# ----------------------------------------------------------------- A13 / L10 fairness
def fairness_audit(audit: DataFrame, dims=("gender", "age_group", "marital_status"),
                   score: str = "p", label: str = "enrolled", threshold: float = 0.5) -> DataFrame:
    """Count, actual rate, predicted rate, mean probability and the
    gap (predicted - actual) per level of each dimension, in one
    ``GROUPING SETS ((gender), (age_group), (marital_status))`` aggregate.

    ``grouping(d)`` tells which set a row belongs to; null levels inside a set
    are dropped, like pandas groupby.
    """
    dims = list(dims)
    if "age_group" in dims and "age_group" not in audit.columns:
        audit = audit.withColumn("age_group", age_band("age"))
    base = audit.select(*[F.col(d).cast("string").alias(d) for d in dims],
                        F.col(label).cast("double").alias("_y"),
                        (F.col(score) >= threshold).cast("double").alias("_pred"), F.col(score).alias("_p"))
    g = base.groupingSets([[d] for d in dims], *dims).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"), F.avg("_y").alias("actual_rate"),
        F.avg("_pred").alias("pred_rate"), F.avg("_p").alias("avg_prob"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dimension, level = None, None
    for d in dims:
        inset = F.col(f"_g_{d}") == 0
        dimension = F.when(inset, F.lit(d)) if dimension is None else dimension.when(inset, F.lit(d))
        level = F.when(inset, F.col(d)) if level is None else level.when(inset, F.col(d))
    out = g.select(dimension.alias("dimension"), level.alias("level"), "count", "actual_rate",
                   "pred_rate", "avg_prob")
    return (out.filter(F.col("level").isNotNull())
               .select("*", (F.col("pred_rate") - F.col("actual_rate")).alias("gap")))
