"""The cleaning/feature job (C1) and its scoring-time twin (C2): one function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.constants import (CATEGORICAL_LEVELS, EXPECTED_FEATURES, CANDIDATE_FEATURES,
                                   EXCLUDED_FEATURES, SPLIT_DROP_COLUMNS)
from benefitlens.functions import canon, dates, flags
from benefitlens.operators.dedup import dedup_keep_none
from benefitlens.operators.joins import join_dimension
from benefitlens.sources.readers import validate_records, with_default_columns


def clean_regions(regions: DataFrame) -> DataFrame:
    """F9 on the dimension: mandate labels canonicalised, unknown -> null."""
    return regions.withColumn("state_mandate_level", canon.canon_mandate("state_mandate_level"))


def add_features(df: DataFrame) -> DataFrame:
    """Dates, sentinels, dictionaries and flags on an already-joined frame.

    Every new column is a built-in expression, so the whole step stays inside
    one whole-stage-codegen span.
    """
    app = dates.parse_day_first("application_date")
    contact = dates.parse_month_first("last_contact_date")
    df = df.withColumns({"app_date": app, "contact_date": contact})
    # an impossible time of day makes the whole value unparseable
    df = df.withColumns({"_app": dates.moment(F.col("app_date"), "application_date"),
                         "_contact": dates.moment(F.col("contact_date"), "last_contact_date")})
    df = df.withColumns({"app_date": F.when(F.col("_app").isNotNull(), F.col("app_date")),
                         "contact_date": F.when(F.col("_contact").isNotNull(), F.col("contact_date"))})
    return df.withColumns({
        "has_application_date": dates.present_flag(F.col("app_date")),
        "days_contact_to_app": dates.days_between_moments(F.col("_app"), F.col("_contact")),
        "contact_after_app": dates.after_flag(F.col("_contact"), F.col("_app")),
        **flags.sentinel_flags("prior_year_enrolled"),
        "last_contact_channel_clean": canon.canon_channel("last_contact_channel"),
        "plan_tier_requested_clean": canon.canon_tier("plan_tier_requested"),
        "broker_channel_clean": canon.fill_unknown("broker_channel"),
        "has_dependents_bin": flags.dependents_flag("has_dependents"),
        "tenure_inconsistent": flags.tenure_flag("tenure_years", "age"),
    }).drop("_app", "_contact")


def engineer_features(emp: DataFrame, regions: DataFrame, dedup: bool = True) -> DataFrame:
    """Dedup (keep none) -> mandate clean -> broadcast join -> features."""
    base = dedup_keep_none(emp, "employee_id") if dedup else emp
    joined = join_dimension(base, clean_regions(regions), "region", "left")
    return add_features(joined)


def apply_domains(df: DataFrame) -> DataFrame:
    """fixed categorical domains; anything outside becomes null."""
    return df.withColumns({c: canon.in_domain(c, levels)
                           for c, levels in CATEGORICAL_LEVELS.items() if c in df.columns})


def preprocess_scoring(records: DataFrame, regions: DataFrame) -> DataFrame:
    """Scoring-time features: validation, defaults, same C1 logic without
    dedup, fixed domains, then the model matrix in its fixed order (PF1).

    Records whose region is missing or unknown are not dropped silently: they
    keep a ``reason`` column (null for valid rows), as IO3 re-aimed.
    """
    checked = validate_records(with_default_columns(records), regions)
    feats = engineer_features(checked, regions, dedup=False)
    keep = [c for c in ["employee_id", "reason"] if c in feats.columns]
    return apply_domains(feats).select(*keep, *EXPECTED_FEATURES)


def feature_matrix(engineered: DataFrame, with_id: bool = True, with_label: bool = False) -> DataFrame:
    """PF1: fixed-order projection of the model matrix."""
    cols = (["employee_id"] if with_id else []) + EXPECTED_FEATURES + (["enrolled"] if with_label else [])
    return engineered.select(*cols)


def exclude_columns(df: DataFrame, names=None) -> DataFrame:
    """PF2: drop-if-exists exclusion list (``drop`` ignores absent names)."""
    return df.drop(*(names or SPLIT_DROP_COLUMNS))


def feature_register(engineered: DataFrame) -> DataFrame:
    """PF3: candidate/excluded register with each column's null count."""
    spark = engineered.sparkSession
    rows = ([(c, "candidate", i) for i, c in enumerate(CANDIDATE_FEATURES)]
            + [(c, "excluded", i) for i, c in enumerate(EXCLUDED_FEATURES)])
    register = spark.createDataFrame(rows, "column_name string, role string, position int")
    present = [c for c, _, _ in rows if c in engineered.columns]
    present = list(dict.fromkeys(present))
    nulls = (engineered.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in present])
             .unpivot([], present, "column_name", "null_count"))
    return register.join(F.broadcast(nulls), "column_name", "left")


def sentinel_variant(engineered: DataFrame, sentinel: float | None = None) -> DataFrame:
    """C4: the small numeric matrix with ``days_contact_to_app`` left null or
    filled by a sentinel."""
    d = F.col("days_contact_to_app").cast("double")
    if sentinel is not None:
        d = F.coalesce(d, F.lit(float(sentinel)))
    return engineered.select("employee_id", F.col("age").cast("double").alias("age"), "salary",
                             "tenure_years", d.alias("days_contact_to_app"),
                             "has_application_date", "enrolled")


def quality_diagnostic(engineered: DataFrame) -> DataFrame:
    """Raw vs clean value per cleaned field, one row per (employee, field)."""
    pairs = {
        "application_date": ("application_date", F.col("app_date").cast("string")),
        "last_contact_date": ("last_contact_date", F.col("contact_date").cast("string")),
        "last_contact_channel": ("last_contact_channel", F.col("last_contact_channel_clean")),
        "plan_tier_requested": ("plan_tier_requested", F.col("plan_tier_requested_clean")),
        "broker_channel": ("broker_channel", F.col("broker_channel_clean")),
        "prior_year_enrolled": ("prior_year_enrolled",
                                F.when(F.col("no_prior_record") == 1, F.lit("no_record"))
                                 .otherwise(F.col("prior_year_enrolled_clean").cast("string"))),
        "has_dependents": ("has_dependents", F.col("has_dependents_bin").cast("string")),
    }
    structs = [F.struct(F.lit(name).alias("field"), F.col(raw).cast("string").alias("raw_value"),
                        clean.alias("clean_value"))
               for name, (raw, clean) in pairs.items()]
    out = engineered.select("employee_id", F.explode(F.array(*structs)).alias("d"))
    return out.select("employee_id", "d.field", "d.raw_value", "d.clean_value",
                      (~F.col("d.raw_value").eqNullSafe(F.col("d.clean_value"))).alias("changed"))
