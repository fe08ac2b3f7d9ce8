"""Serving-side jobs around a fitted model (L4, L5, M11, M24, IO8)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.constants import FAIR_AI_NOTE, TIER_MAP
from benefitlens.functions.canon import lookup_trim_retry
from benefitlens.operators.governance import fairness_audit, narrative, reason_codes, refuse_leakage
from benefitlens.operators.joins import match_requests
from benefitlens.operators.metrics import precision_lift_at_k
from benefitlens.operators.ranking import rank_capacity, rank_summary
from benefitlens.plans import modeling
from benefitlens.plans.features import preprocess_scoring


def score_records(model: PipelineModel, records: DataFrame, regions: DataFrame) -> DataFrame:
    """Score supplied records; invalid ones carry an error instead of a score."""
    s = modeling.score(model, modeling.prepare(preprocess_scoring(records, regions)))
    valid = F.col("reason").isNull()
    return s.select("employee_id",
                    F.when(valid, F.lit("success")).otherwise(F.lit("error")).alias("status"),
                    F.when(valid, F.round("predicted_probability", 4)).alias("enrollment_probability"),
                    F.when(valid, F.col("predicted_class")).alias("predicted_enrolled"),
                    F.col("reason").alias("error"))


def score_requests(model: PipelineModel, requests: DataFrame, raw: DataFrame, regions: DataFrame) -> DataFrame:
    """L4 on a request table ``(request_id, employee_id, feature_requested)``.

    Leaky feature requests become refusal rows; unknown ids become
    ``not_found`` rows (G19); the rest are scored through the shared C2 job
    and returned with raw and clean attributes (no protected columns). A
    record that C2 rejects is an ``error`` row, as in ``score_records``.
    """
    req = refuse_leakage(requests)
    ok, not_found = match_requests(req.filter(F.col("status") == "ok").select("request_id", "employee_id"), raw)
    matched = raw.join(ok.select("employee_id").distinct(), "employee_id", "left_semi")
    scores = modeling.score(model, modeling.prepare(preprocess_scoring(matched, regions)))
    attrs = matched.select("employee_id", "salary", "region",
                           lookup_trim_retry("plan_tier_requested", TIER_MAP).alias("plan_tier_requested_clean"))
    valid = F.col("reason").isNull()
    scored = (ok.join(attrs, "employee_id")
              .join(scores.select("employee_id", "reason", "predicted_probability", "predicted_class"), "employee_id")
              .select("request_id", "employee_id", F.when(valid, F.lit("success")).otherwise(F.lit("error")).alias("status"),
                      "salary", "region", "plan_tier_requested_clean",
                      F.when(valid, F.round("predicted_probability", 4)).alias("enrollment_probability"),
                      F.when(valid, F.col("predicted_class")).alias("predicted_enrolled"),
                      F.col("reason").alias("error")))
    refused = req.filter(F.col("status") == "refusal").select("request_id", "employee_id",
                                                                 F.lit("refusal").alias("status"))
    missing = not_found.select("request_id", "employee_id", F.lit("not_found").alias("status"))
    return (scored.unionByName(missing, allowMissingColumns=True)
                  .unionByName(refused, allowMissingColumns=True))


def rank_scored(model: PipelineModel, records: DataFrame, regions: DataFrame, top_k: int | None = None):
    """C2 -> M11 -> W6/W8: the capacity ranking of records scored by the model, and its summary per region.

    Records that C2 rejects (no region, or an unknown one) aren't eligible.
    """
    prepared = modeling.prepare(preprocess_scoring(records, regions).filter(F.col("reason").isNull()))
    scored = (modeling.score(model, prepared).select("employee_id", F.col("predicted_probability").alias("p"), "predicted_class")
              .join(records.select("employee_id", "region", "employment_type"), "employee_id"))
    return rank_capacity(scored, regions, top_k), rank_summary(scored, regions, top_k)


def explain_scored(model: PipelineModel, records: DataFrame, regions: DataFrame) -> DataFrame:
    """C2 -> M11 -> L6-L8: each record's narrative on the model's probability,
    its reason codes and the fairness note; records that C2 rejects are error
    rows.  ``records`` hold one row per id.
    """
    s = modeling.score(model, modeling.prepare(preprocess_scoring(records, regions)))
    s = s.select("employee_id", "reason", F.col("predicted_probability").alias("_p"), "predicted_class")
    told = reason_codes(records).select("employee_id", "top_drivers").join(s, "employee_id")
    valid = F.col("reason").isNull()
    return told.select(
        "employee_id", F.when(valid, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(valid, F.round("_p", 4)).alias("enrollment_probability"),
        F.when(valid, F.col("predicted_class")).alias("predicted_enrolled"),
        F.when(valid, narrative(F.col("_p"), F.col("employee_id"))).alias("narrative_summary"),
        F.when(valid, F.to_json("top_drivers")).alias("top_drivers"),
        F.when(valid, F.lit(FAIR_AI_NOTE)).alias("fair_ai_note"), F.col("reason").alias("error"))


def lift_scored(scored: DataFrame, source: DataFrame, regions: DataFrame) -> DataFrame:
    """M11 -> M21: precision and lift at K of the model's own test scores, per region."""
    s = scored.select("employee_id", "enrolled", F.col("predicted_probability").alias("p"))
    return precision_lift_at_k(s.join(source.select("employee_id", "region"), "employee_id"), regions)


def audit_scored(scored: DataFrame, demographics: DataFrame) -> DataFrame:
    """M11 -> A13: the fairness audit of the model's own test scores."""
    audit = scored.select("employee_id", "enrolled", F.col("predicted_probability").alias("p")).join(
        demographics.select("employee_id", "gender", "age", "marital_status"), "employee_id")
    return fairness_audit(audit)


def score_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """M24/IO8: rows compared by key: count, max |p_a - p_b| and class agreement."""
    x = a.select("employee_id", F.col("predicted_probability").alias("_a"), F.col("predicted_class").alias("_ca"))
    y = b.select("employee_id", F.col("predicted_probability").alias("_b"), F.col("predicted_class").alias("_cb"))
    return x.join(y, "employee_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"),
        F.min((F.col("_ca") == F.col("_cb")).cast("int")).alias("classes_equal"))
