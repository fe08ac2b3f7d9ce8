"""Refusal, screening, explanation and fairness rules."""
from pyspark.sql import functions as F

from benefitlens.constants import PROTECTED_ATTRIBUTES
from benefitlens.operators import governance as G

FULL_RECORD = dict(employee_id=99999, age=45, salary=85000.0, region="West", employment_type="Full-time",
                   has_dependents="Yes", tenure_years=5.0, prior_year_enrolled=1, application_date="2023-05-10",
                   last_contact_date="2023-05-01", last_contact_channel="Email", plan_tier_requested="Silver")


def test_prompt_screening_examples(spark):
    prompts = ["What is the enrollment probability for employee 12324?",
               "Which insurance plan is best to treat my diabetes?",
               "Please filter out female employees from the outreach list.",
               "Rank top 10 employees by enrollment probability in West region.",
               "The air conditioning is curative.", "   ", None,
               "I need a Doctor to discriminate"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(prompts)], "i int, text string")
    got = {r.i: r.refusal_type for r in G.screen_prompts(df).collect()}
    assert got == {0: None, 1: "MEDICAL_ADVICE_REFUSAL", 2: "DISCRIMINATION_GUARDRAIL_REFUSAL", 3: None,
                   4: None, 5: None, 6: None, 7: "MEDICAL_ADVICE_REFUSAL"}


def test_leakage_refusal_is_case_insensitive_substring(spark):
    df = spark.createDataFrame([(1, 1, "legacy_propensity_score"), (2, 1, "LEGACY_PROPENSITY_SCORE_x"),
                                (3, 1, "salary"), (4, 1, None)], "request_id int, employee_id int, feature_requested string")
    got = {r.request_id: r.status for r in G.refuse_leakage(df).collect()}
    assert got == {1: "refusal", 2: "refusal", 3: "ok", 4: "ok"}
    assert G.table_has_leak(df.withColumn("legacy_propensity_score", F.lit(0.9)))


def test_reason_codes_full_record_and_protected_filter(spark):
    df = spark.createDataFrame([FULL_RECORD])
    r = G.reason_codes(df).first()
    feats = [(d.feature, d.effect) for d in r.top_drivers]
    assert feats == [("has_dependents", "Positive"), ("salary", "Positive"), ("employment_type", "Positive"),
                     ("prior_year_enrolled", "Positive"), ("plan_tier_requested", "Positive")]
    assert r.top_drivers[1].reasoning.startswith("Annual salary ($85,000.00)")
    assert "(Silver)" in r.top_drivers[4].reasoning
    assert not any(d.feature in PROTECTED_ATTRIBUTES for d in r.top_drivers)


def test_reason_codes_missing_values(spark):
    df = spark.createDataFrame([(1, None, None, None, None, "Gold Plan")],
                               "employee_id int, has_dependents string, salary double, employment_type string, "
                               "prior_year_enrolled int, plan_tier_requested string")
    r = G.reason_codes(df).first()
    assert [(d.feature, d.effect) for d in r.top_drivers] == [("has_dependents", "Negative"), ("salary", "Positive")]
    assert "$60,000.00" in r.top_drivers[1].reasoning


def test_narrative_text(spark):
    df = spark.createDataFrame([(99999, 0.87654), (None, 0.2)], "employee_id int, p double")
    got = [r.n for r in df.select(G.narrative(F.col("p"), F.col("employee_id")).alias("n")).collect()]
    assert got[0] == ("Employee 99999 is predicted as highly likely to enroll with an estimated "
                      "enrollment probability of 87.65%.")
    assert got[1].startswith("This employee is predicted as unlikely to enroll")
    for text in got:
        assert not any(p in text for p in ("gender", "marital", " age"))


def test_fairness_audit_drops_null_levels(spark):
    df = spark.createDataFrame([("F", 25, "Single", 0.7, 1), ("M", 66, "Married", 0.2, 0), ("F", 40, None, 0.6, 0)],
                               "gender string, age int, marital_status string, p double, enrolled int")
    got = {(r.dimension, r.level): r for r in G.fairness_audit(df).collect()}
    assert got[("gender", "F")]["count"] == 2 and got[("gender", "F")].pred_rate == 1.0
    assert ("age_group", None) not in got and ("marital_status", None) not in got
    assert got[("gender", "F")].gap == 1.0 - 0.5


def test_leakage_screen_flags_the_leaky_column(spark):
    rows = [(i % 2, 0.8 + (i % 10) / 100 if i % 2 else 0.1 + (i % 10) / 100, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "enrolled int, legacy double, noise double")
    got = {r.column_name: r for r in G.leakage_screen(df, ["legacy", "noise"]).collect()}
    assert got["legacy"].verdict == "LEAKY" and got["legacy"].solo_auc == 1.0
    assert got["noise"].verdict == "REVIEW"
