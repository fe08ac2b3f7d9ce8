"""Registered queries: one per operator key of the blueprint.

Each entry takes ``(spark, sf_dir)``, reads the driver's tables (through the
fixture views derived from them) and returns a lazy DataFrame.  Outputs are
normalised (integers as BIGINT, floats rounded) for the value check.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benefitlens.plans.scoring import normalize, scored_fixture
from benefitlens.sources.fixtures import emp_raw, region_profile

REGISTRY: dict = {}


def query(name):
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        REGISTRY[name] = run
        return fn
    return deco


# --------------------------------------------------------------------------- helpers
def _emp(spark, sf):
    return emp_raw(spark, sf)


def _reg(spark, sf):
    return region_profile(spark, sf)


def _scored(spark, sf):
    return scored_fixture(_emp(spark, sf))


# --------------------------------------------------------------------------- ranking
@query("rank_capacity")
def q_rank_capacity(spark, sf):
    from benefitlens.operators.ranking import rank_capacity
    r = rank_capacity(_scored(spark, sf), _reg(spark, sf), top_k=None)
    return r.select("region", "rank", "employee_id", "employment_type", "enrolled", "p", "capacity")


def _dedup(spark, sf):
    from benefitlens.operators.dedup import dedup_keep_none
    return dedup_keep_none(_emp(spark, sf), "employee_id")


def _eng(spark, sf):
    from benefitlens.plans.features import engineer_features
    return engineer_features(_emp(spark, sf), _reg(spark, sf))


def _split_scored(spark, sf):
    """Scored rows with the stratified split/fold columns, checkpointed to the
    shared folder: the split is consumed several times downstream and is
    written once instead of being recomputed by each consumer."""
    from benefitlens.operators.split import stratified_split
    from benefitlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return stratified_split(_scored(spark, sf), "enrolled", "employee_id").checkpoint(eager=True)


# --------------------------------------------------------------------------- sources (IO)
def _as_csv(spark, df, name):
    """Land a table as header CSV in the shared folder (as the raw files arrive)."""
    import uuid
    from benefitlens.session import shared_path
    path = shared_path(spark, "landing", name, uuid.uuid4().hex)
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@query("io_read_raw")
def q_io_read_raw(spark, sf):
    """IO1: header CSV -> declared schema, pandas null tokens, typed columns."""
    from benefitlens.sources.readers import read_employees_csv
    return read_employees_csv(spark, _as_csv(spark, _emp(spark, sf), "employees"), multi_line=True)


@query("io_read_region")
def q_io_read_region(spark, sf):
    """IO2: the dimension CSV read the same way."""
    from benefitlens.sources.readers import read_regions_csv
    return read_regions_csv(spark, _as_csv(spark, _reg(spark, sf), "regions"))


def _arriving_records(spark, sf):
    """Records as they would arrive for scoring: every 50th without a region,
    every 50th+1 with a lower-cased (hence unknown) region."""
    e = _emp(spark, sf)
    k = F.col("employee_id") % 50
    return e.withColumn("region", F.when(k == 0, F.lit(None).cast("string"))
                        .when(k == 1, F.lower("region")).otherwise(F.col("region")))


@query("io_validate_records")
def q_io_validate_records(spark, sf):
    from benefitlens.sources.readers import validate_records
    return validate_records(_arriving_records(spark, sf), _reg(spark, sf)) \
        .select("employee_id", "region", "reason")


@query("default_columns")
def q_default_columns(spark, sf):
    from benefitlens.constants import SCORING_DEFAULTS
    from benefitlens.sources.readers import with_default_columns
    part = _emp(spark, sf).select("employee_id", "region", "age", "salary")
    return with_default_columns(part).select("employee_id", "region", "age", "salary",
                                             *[c for c in SCORING_DEFAULTS if c not in ("age", "salary")])


def _write_split_table(spark, sf):
    import uuid
    from benefitlens.operators.split import stratified_split
    from benefitlens.session import shared_path
    from benefitlens.sources.sinks import write_splits
    path = shared_path(spark, "splits", uuid.uuid4().hex)
    write_splits(stratified_split(_eng(spark, sf)).drop("class_rank"), path)
    return path


@query("io_write_splits")
def q_io_write_splits(spark, sf):
    from benefitlens.sources.sinks import read_splits
    path = _write_split_table(spark, sf)
    return read_splits(spark, path).groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("io_read_split")
def q_io_read_split(spark, sf):
    from benefitlens.sources.sinks import read_split
    path = _write_split_table(spark, sf)
    return read_split(spark, path, "test").select("employee_id", "enrolled", "region", "salary", "split")


@query("io_json_rows")
def q_io_json_rows(spark, sf):
    from benefitlens.operators.ranking import rank_capacity, ranking_rows
    from benefitlens.sources.sinks import json_rows
    r = rank_capacity(_scored(spark, sf), _reg(spark, sf), top_k=10)
    return json_rows(ranking_rows(r, _dedup(spark, sf)))


@query("head_n")
def q_head_n(spark, sf):
    return _eng(spark, sf).orderBy("employee_id").limit(10).select("employee_id", "region", "salary")


# --------------------------------------------------------------------------- projections / filters
@query("feature_matrix")
def q_feature_matrix(spark, sf):
    from benefitlens.plans.features import feature_matrix
    return feature_matrix(_eng(spark, sf), with_id=True)


@query("exclude_columns")
def q_exclude_columns(spark, sf):
    from benefitlens.plans.features import exclude_columns
    return exclude_columns(_eng(spark, sf))


@query("feature_register")
def q_feature_register(spark, sf):
    from benefitlens.plans.features import feature_register
    return feature_register(_eng(spark, sf))


@query("filter_eq")
def q_filter_eq(spark, sf):
    return _eng(spark, sf).filter(F.col("enrolled") == 1).select("employee_id", "legacy_propensity_score")


@query("filter_ci_status")
def q_filter_ci_status(spark, sf):
    from benefitlens.operators.ranking import filter_ci_status
    return filter_ci_status(_dedup(spark, sf), "region", ["WEST", "south", "Atlantis"])


@query("canon_no_nulls")
def q_canon_no_nulls(spark, sf):
    """F11's assertion: no canonical label is null after the dictionaries."""
    from benefitlens.operators.joins import null_report
    r = null_report(_eng(spark, sf), ["last_contact_channel_clean", "plan_tier_requested_clean", "broker_channel_clean"])
    return r.withColumn("no_nulls", F.col("null_count") == 0)


@query("filter_ci")
def q_filter_ci(spark, sf):
    from benefitlens.operators.ranking import filter_ci
    return filter_ci(_dedup(spark, sf), "region", "WEST").select("employee_id", "region")


@query("filter_isin")
def q_filter_isin(spark, sf):
    """Ids requested through urgent orders; unknown ids drop out (semi-join)."""
    from benefitlens.sources.tables import read_table
    req = (read_table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
           .select(F.col("o_custkey").alias("employee_id")).distinct())
    d = _dedup(spark, sf)
    return d.join(req, d["employee_id"] == req["employee_id"], "left_semi") \
            .select("employee_id", "region", "salary")


@query("filter_notnull")
def q_filter_notnull(spark, sf):
    return _dedup(spark, sf).na.drop(subset=["application_date", "legacy_propensity_score"]) \
        .select("employee_id", "application_date", "legacy_propensity_score")


@query("filter_range")
def q_filter_range(spark, sf):
    return _emp(spark, sf).filter(F.col("salary") < 15000.0) \
        .select("employee_id", "age", "salary", "employment_type", "tenure_years")


@query("sentinel_long_tenure")
def q_sentinel_long_tenure(spark, sf):
    d = _dedup(spark, sf)
    return d.filter((F.col("prior_year_enrolled") == -1) & (F.col("tenure_years") >= 1.0)) \
        .select("employee_id", "tenure_years")


@query("messy_rows")
def q_messy_rows(spark, sf):
    from benefitlens.operators.joins import any_true
    e = _eng(spark, sf)
    cond = any_true([F.col("has_application_date") == 0, F.col("contact_after_app") == 1,
                     F.col("tenure_inconsistent") == 1, F.col("no_prior_record") == 1,
                     F.col("last_contact_channel_clean") == "Unknown",
                     F.col("plan_tier_requested_clean") == "Unknown"])
    return e.filter(cond).select("employee_id")


@query("date_format_profile")
def q_date_format_profile(spark, sf):
    from benefitlens.operators.profile import date_format_profile
    return date_format_profile(_emp(spark, sf), "application_date")


# --------------------------------------------------------------------------- joins
@query("join_region")
def q_join_region(spark, sf):
    from benefitlens.operators.joins import join_dimension
    from benefitlens.plans.features import clean_regions
    j = join_dimension(_dedup(spark, sf), clean_regions(_reg(spark, sf)), "region")
    return j.select("employee_id", "region", "hist_enrollment_rate_region", "hr_outreach_capacity",
                    "state_mandate_level")


@query("join_cardinality")
def q_join_cardinality(spark, sf):
    from benefitlens.operators.joins import join_cardinality
    return join_cardinality(_dedup(spark, sf), _reg(spark, sf), "region")


@query("join_unmatched")
def q_join_unmatched(spark, sf):
    from benefitlens.operators.joins import unmatched_keys
    return unmatched_keys(_dedup(spark, sf), _reg(spark, sf), "region")


@query("join_scores_back")
def q_join_scores_back(spark, sf):
    s = _scored(spark, sf).select("employee_id", "p")
    return _dedup(spark, sf).join(s, "employee_id", "inner").select("employee_id", "age", "salary", "region", "p")


@query("join_scores_raw")
def q_join_scores_raw(spark, sf):
    """J4 onto all raw rows: ids with many copies are spread, not sent to one task."""
    from benefitlens.operators.joins import spread_join
    raw = _emp(spark, sf).select("employee_id", "salary", "region")
    scores = raw.groupBy("employee_id").agg(F.round(F.avg("salary"), 2).alias("mean_salary"))
    return spread_join(raw, scores, "employee_id", "left")


@query("reconcile_region")
def q_reconcile_region(spark, sf):
    from benefitlens.operators.joins import reconcile
    return reconcile(_eng(spark, sf), _reg(spark, sf), "region", [
        ("count", F.count("employee_id").cast("double"), "n_employees_region"),
        ("avg_salary", F.round(F.avg("salary"), 2), "avg_salary_region"),
        ("rate", F.avg(F.col("enrolled").cast("double")), "hist_enrollment_rate_region"),
    ])


@query("audit_join")
def q_audit_join(spark, sf):
    test = _split_scored(spark, sf).filter(F.col("split") == "test").select("employee_id", "p", "enrolled")
    demo = _dedup(spark, sf).select("employee_id", "gender", "age", "marital_status")
    return test.join(demo, "employee_id", "inner")


@query("join_null_report")
def q_join_null_report(spark, sf):
    from benefitlens.operators.joins import null_report
    e = _eng(spark, sf)
    cols = ["n_employees_region", "hist_enrollment_rate_region", "avg_salary_region", "avg_premium_cost_usd",
            "benefits_broker_rating", "hr_outreach_capacity", "open_enrollment_window_days", "state_mandate_level"]
    return null_report(e, cols)


# --------------------------------------------------------------------------- aggregates / profiles
def _raw_typed(spark, sf):
    from benefitlens.schemas import EMP_SCHEMA
    from benefitlens.sources.readers import conform
    return conform(_emp(spark, sf), EMP_SCHEMA)


MISSING_COLS = ["application_date", "last_contact_channel", "plan_tier_requested", "broker_channel",
                "legacy_propensity_score", "outreach_notes"]


@query("profile_table")
def q_profile_table(spark, sf):
    from benefitlens.operators.profile import profile_table
    return profile_table(_raw_typed(spark, sf))


@query("missing_profile")
def q_missing_profile(spark, sf):
    from benefitlens.operators.profile import missing_profile
    return missing_profile(_dedup(spark, sf))


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    from benefitlens.operators.profile import describe_numeric
    return describe_numeric(_emp(spark, sf))


@query("describe_by_group")
def q_describe_by_group(spark, sf):
    from benefitlens.operators.profile import describe_by_group
    return describe_by_group(_dedup(spark, sf), "enrolled", "legacy_propensity_score")


@query("value_counts")
def q_value_counts(spark, sf):
    from benefitlens.operators.profile import value_counts
    return value_counts(_dedup(spark, sf), "last_contact_channel")


@query("value_counts_norm")
def q_value_counts_norm(spark, sf):
    from benefitlens.operators.profile import value_counts
    return value_counts(_dedup(spark, sf), "prior_year_enrolled", normalize=True)


@query("cardinality_top5")
def q_cardinality_top5(spark, sf):
    from benefitlens.operators.profile import cardinality_top5
    return cardinality_top5(_emp(spark, sf))


WIDE_COLUMNS = ["user_id", "event_type", "props"]


@query("top_values_wide")
def q_top_values_wide(spark, sf):
    """A7 on the event table's text forms: nearly unique columns among them."""
    from benefitlens.operators.heavy import top_values
    return top_values(spark.read.parquet(f"{sf}/events.parquet"), WIDE_COLUMNS)


@query("cardinality_approx")
def q_cardinality_approx(spark, sf):
    """A7's estimated distinct counts beside the exact ones: within three standard deviations."""
    from benefitlens.operators.heavy import approx_cardinality
    e = spark.read.parquet(f"{sf}/events.parquet").select(*[F.col(c).cast("string").alias(c) for c in WIDE_COLUMNS])
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in WIDE_COLUMNS]).unpivot([], WIDE_COLUMNS, "column_name", "n_exact")
    j = approx_cardinality(e, WIDE_COLUMNS).join(exact, "column_name")
    return j.select("column_name", "n_exact", (F.abs(F.col("n_unique") - F.col("n_exact")) <= 3 * F.col("relative_sd") * F.col("n_exact")).alias("within"))


@query("distinct_levels")
def q_distinct_levels(spark, sf):
    from benefitlens.operators.profile import distinct_levels
    return distinct_levels(_eng(spark, sf), "plan_tier_requested_clean")


@query("rate_by_group")
def q_rate_by_group(spark, sf):
    from benefitlens.operators.profile import rate_by_group
    return rate_by_group(_dedup(spark, sf), "prior_year_enrolled")


@query("rate_by_sentinel_pair")
def q_rate_by_sentinel_pair(spark, sf):
    from benefitlens.operators.profile import rate_by_group
    return rate_by_group(_eng(spark, sf), ["no_prior_record", "prior_year_enrolled_clean"])


@query("count_by_group")
def q_count_by_group(spark, sf):
    from benefitlens.operators.profile import count_by_group
    return count_by_group(_eng(spark, sf), "region")


@query("first_by_group")
def q_first_by_group(spark, sf):
    from benefitlens.operators.profile import first_by_group
    return first_by_group(_eng(spark, sf), "region", "hist_enrollment_rate_region")


@query("crosstab")
def q_crosstab(spark, sf):
    from benefitlens.operators.profile import crosstab
    from benefitlens.sources.tables import read_table
    return crosstab(read_table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query("crosstab_margins")
def q_crosstab_margins(spark, sf):
    from benefitlens.operators.profile import crosstab_margins
    e = _emp(spark, sf).withColumn("has_application_date", F.col("application_date").isNotNull())
    return crosstab_margins(e, "has_application_date", "enrolled")


@query("crosstab_rowpct")
def q_crosstab_rowpct(spark, sf):
    from benefitlens.operators.profile import crosstab_rowpct
    return crosstab_rowpct(_emp(spark, sf), "plan_tier_requested", "enrolled", [0, 1])


@query("corr_target")
def q_corr_target(spark, sf):
    from benefitlens.operators.profile import corr_with_target
    return corr_with_target(_eng(spark, sf), ["legacy_propensity_score", "hist_enrollment_rate_region"])


@query("corr_all_target")
def q_corr_all_target(spark, sf):
    from benefitlens.operators.profile import corr_with_target
    return corr_with_target(_emp(spark, sf), ["age", "salary", "tenure_years", "prior_year_enrolled",
                                             "legacy_propensity_score"])


@query("missing_corr")
def q_missing_corr(spark, sf):
    from benefitlens.operators.profile import missing_corr
    return missing_corr(_dedup(spark, sf), MISSING_COLS)


@query("missing_cooccur")
def q_missing_cooccur(spark, sf):
    from benefitlens.operators.profile import missing_cooccur
    return missing_cooccur(_dedup(spark, sf), MISSING_COLS[:4])


@query("quantiles")
def q_quantiles(spark, sf):
    from benefitlens.operators.profile import quantiles
    return quantiles(_emp(spark, sf), "salary", [0.001, 0.005, 0.01, 0.05, 0.1, 0.5])


@query("chronology_stats")
def q_chronology_stats(spark, sf):
    from benefitlens.operators.profile import chronology_stats
    return chronology_stats(_eng(spark, sf))


@query("date_parse_failures")
def q_date_parse_failures(spark, sf):
    from benefitlens.functions.dates import parse_day_first, parse_month_first
    from benefitlens.operators.profile import date_parse_failures
    d = _emp(spark, sf)
    a = date_parse_failures(d, "application_date", parse_day_first("application_date")) \
        .select(F.lit("application_date").alias("column_name"), "employee_id",
                F.col("application_date").alias("raw_value"))
    b = date_parse_failures(d, "last_contact_date", parse_month_first("last_contact_date")) \
        .select(F.lit("last_contact_date").alias("column_name"), "employee_id",
                F.col("last_contact_date").alias("raw_value"))
    return a.unionByName(b)


@query("start_age_profile")
def q_start_age_profile(spark, sf):
    from benefitlens.operators.profile import start_age_profile
    return start_age_profile(_emp(spark, sf))


@query("duplicate_conflicts")
def q_duplicate_conflicts(spark, sf):
    from benefitlens.operators.dedup import duplicate_conflicts
    return duplicate_conflicts(_emp(spark, sf), "employee_id", "enrolled")


@query("duplicates_by_region")
def q_duplicates_by_region(spark, sf):
    from benefitlens.operators.dedup import duplicates_by_region
    return duplicates_by_region(_emp(spark, sf), "employee_id", "region")


@query("split_balance")
def q_split_balance(spark, sf):
    from benefitlens.operators.split import split_balance, stratified_split
    return split_balance(stratified_split(_eng(spark, sf)))


# --------------------------------------------------------------------------- duplicates / windows / top-K
@query("dedup_keep_none")
def q_dedup_keep_none(spark, sf):
    return _dedup(spark, sf)


@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf):
    from benefitlens.operators.dedup import dedup_keep_first
    e = _emp(spark, sf).withColumn("_score_missing", F.col("legacy_propensity_score").isNull())
    return dedup_keep_first(e, "employee_id", ["_score_missing", "enrolled"]).drop("_score_missing")


@query("mark_duplicates")
def q_mark_duplicates(spark, sf):
    from benefitlens.operators.dedup import mark_duplicates
    from benefitlens.sources.tables import read_table
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return mark_duplicates(li, ["l_orderkey", "l_linenumber"])


@query("sort_scores")
def q_sort_scores(spark, sf):
    from benefitlens.operators.ranking import sort_scores
    return sort_scores(_scored(spark, sf)).select("employee_id", "p")


@query("rank_topk")
def q_rank_topk(spark, sf):
    from benefitlens.operators.ranking import rank_topk
    return rank_topk(_scored(spark, sf), 10).select("rank", "employee_id", "p")


@query("rank_filtered")
def q_rank_filtered(spark, sf):
    from benefitlens.operators.ranking import rank_capacity
    r = rank_capacity(_scored(spark, sf), _reg(spark, sf), top_k=10, ascending=True,
                      region_filter="west", employment_type="full-time")
    return r.select("region", "rank", "employee_id", "employment_type", "p")


@query("rank_summary")
def q_rank_summary(spark, sf):
    from benefitlens.operators.ranking import rank_summary
    return rank_summary(_scored(spark, sf), _reg(spark, sf), top_k=None)


@query("region_profile")
def q_region_profile(spark, sf):
    from benefitlens.operators.ranking import region_profile_lookup
    return region_profile_lookup(_reg(spark, sf))


@query("split_overlap")
def q_split_overlap(spark, sf):
    from benefitlens.operators.split import split_overlap, stratified_split
    return split_overlap(stratified_split(_eng(spark, sf)), ("salary", "age", "region"))


# --------------------------------------------------------------------------- scalar functions
@query("parse_dates")
def q_parse_dates(spark, sf):
    return _eng(spark, sf).select("employee_id", "application_date", "app_date", "last_contact_date",
                                  "contact_date")


@query("days_contact_to_app")
def q_days_contact_to_app(spark, sf):
    return _eng(spark, sf).select("employee_id", "days_contact_to_app")


@query("contact_after_app")
def q_contact_after_app(spark, sf):
    return _eng(spark, sf).select("employee_id", "contact_after_app")


@query("has_application_date")
def q_has_application_date(spark, sf):
    return _eng(spark, sf).select("employee_id", "has_application_date")


@query("sentinel_flags")
def q_sentinel_flags(spark, sf):
    return _eng(spark, sf).select("employee_id", "prior_year_enrolled", "no_prior_record",
                                  "prior_year_enrolled_clean")


@query("canon_channel")
def q_canon_channel(spark, sf):
    return _eng(spark, sf).select("employee_id", "last_contact_channel", "last_contact_channel_clean")


@query("canon_tier")
def q_canon_tier(spark, sf):
    return _eng(spark, sf).select("employee_id", "plan_tier_requested", "plan_tier_requested_clean")


@query("canon_mandate")
def q_canon_mandate(spark, sf):
    from benefitlens.functions.canon import canon_mandate
    return _reg(spark, sf).select("region", "state_mandate_level",
                                  canon_mandate("state_mandate_level").alias("state_mandate_level_clean"))


@query("unmapped_labels")
def q_unmapped_labels(spark, sf):
    from benefitlens.constants import CHANNEL_MAP, MANDATE_MAP, TIER_MAP
    from benefitlens.functions.canon import lookup
    d, r = _dedup(spark, sf), _reg(spark, sf)

    def unmapped(df, col, mapping):
        return (df.filter(F.col(col).isNotNull() & lookup(col, mapping).isNull())
                .select(F.lit(col).alias("column_name"), F.col(col).alias("raw_value")).distinct())
    return (unmapped(d, "last_contact_channel", CHANNEL_MAP)
            .unionByName(unmapped(d, "plan_tier_requested", TIER_MAP))
            .unionByName(unmapped(r, "state_mandate_level", MANDATE_MAP)))


@query("canon_report")
def q_canon_report(spark, sf):
    e = _eng(spark, sf)
    a = e.groupBy(F.lit("last_contact_channel").alias("column_name"),
                  F.col("last_contact_channel").alias("raw_value"),
                  F.col("last_contact_channel_clean").alias("clean_value")).count()
    b = e.groupBy(F.lit("plan_tier_requested").alias("column_name"),
                  F.col("plan_tier_requested").alias("raw_value"),
                  F.col("plan_tier_requested_clean").alias("clean_value")).count()
    return a.unionByName(b).withColumn("count", F.col("count").cast("bigint"))


@query("canon_trim")
def q_canon_trim(spark, sf):
    from benefitlens.constants import CHANNEL_MAP, TIER_MAP
    from benefitlens.functions.canon import lookup_trim_retry
    d = _dedup(spark, sf)
    return d.select("employee_id",
                    lookup_trim_retry("plan_tier_requested", TIER_MAP).alias("plan_tier_requested_clean"),
                    lookup_trim_retry("last_contact_channel", CHANNEL_MAP).alias("last_contact_channel_clean"))


@query("fill_unknown")
def q_fill_unknown(spark, sf):
    return _eng(spark, sf).select("employee_id", "broker_channel", "broker_channel_clean")


@query("median_impute")
def q_median_impute(spark, sf):
    from benefitlens.operators.impute import median_impute
    from benefitlens.operators.split import stratified_split
    s = stratified_split(_eng(spark, sf))
    out = median_impute(s, ["days_contact_to_app"], fit_on=F.col("split") == "train")
    return out.select("employee_id", "split", "days_contact_to_app_imputed")


@query("dependents_flag")
def q_dependents_flag(spark, sf):
    return _eng(spark, sf).select("employee_id", "has_dependents", "has_dependents_bin")


@query("tenure_flag")
def q_tenure_flag(spark, sf):
    return _eng(spark, sf).select("employee_id", "age", "tenure_years", "tenure_inconsistent")


@query("categorical_domain")
def q_categorical_domain(spark, sf):
    from benefitlens.constants import CATEGORICAL_LEVELS
    from benefitlens.plans.features import apply_domains
    return apply_domains(_eng(spark, sf)).select("employee_id", *CATEGORICAL_LEVELS)


@query("category_codes")
def q_category_codes(spark, sf):
    from benefitlens.operators.encode import category_codes
    d = _dedup(spark, sf)
    return category_codes(d, "employment_type").select("employee_id", "employment_type", "employment_type_code")


@query("age_bands")
def q_age_bands(spark, sf):
    from benefitlens.functions.flags import age_band
    return _dedup(spark, sf).select("employee_id", "age", age_band("age").alias("age_group"))


@query("text_case")
def q_text_case(spark, sf):
    from benefitlens.functions.text import py_strip
    d = _dedup(spark, sf)
    t = F.col("plan_tier_requested")
    return d.select("employee_id", "plan_tier_requested", F.lower(t).alias("lower_value"),
                    py_strip(t).alias("stripped_value"),
                    F.initcap(F.lower(py_strip(t))).alias("title_value"))


def _prompts(spark, sf):
    """Conversation turns with a screening phrase mixed into some of them."""
    from benefitlens.sources.tables import read_table
    c = read_table(spark, sf, "conversations")
    k = (F.col("conv_id") + F.col("turn")) % 11
    marker = (F.when(k == 0, F.lit(" Which plan is best to treat my diabetes?"))
              .when(k == 1, F.lit(" Please filter out female employees from the list."))
              .when(k == 2, F.lit(" I need a Doctor."))
              .when(k == 3, F.lit(" We must never discriminate."))
              .when(k == 4, F.lit(" exclude men from outreach"))
              .when(k == 5, F.lit(" the air conditioning is curative"))
              .otherwise(F.lit("")))
    return c.select("conv_id", "turn", F.concat(F.col("text"), marker).alias("text"))


@query("screen_prompts")
def q_screen_prompts(spark, sf):
    from benefitlens.operators.governance import screen_prompts
    return screen_prompts(_prompts(spark, sf)).select("conv_id", "turn", "allowed", "refusal_type")


# --------------------------------------------------------------------------- composite jobs
@query("engineer_features")
def q_engineer_features(spark, sf):
    return _eng(spark, sf)


@query("preprocess_scoring")
def q_preprocess_scoring(spark, sf):
    from benefitlens.plans.features import preprocess_scoring
    return preprocess_scoring(_arriving_records(spark, sf), _reg(spark, sf))


@query("quality_diagnostic")
def q_quality_diagnostic(spark, sf):
    from benefitlens.plans.features import quality_diagnostic
    return quality_diagnostic(_eng(spark, sf))


@query("sentinel_variant")
def q_sentinel_variant(spark, sf):
    from benefitlens.plans.features import sentinel_variant
    return sentinel_variant(_eng(spark, sf), -999.0)


@query("stratified_split")
def q_stratified_split(spark, sf):
    from benefitlens.operators.split import stratified_split
    return stratified_split(_eng(spark, sf)).select("employee_id", "enrolled", "class_rank", "split", "fold")


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    from benefitlens.operators.split import stratified_folds
    return stratified_folds(_eng(spark, sf)).select("employee_id", "enrolled", "class_rank", "fold")


@query("split_sample")
def q_split_sample(spark, sf):
    from benefitlens.operators.split import split_sample, stratified_split
    return split_sample(stratified_split(_eng(spark, sf)), 10)


@query("oof_region_rate")
def q_oof_region_rate(spark, sf):
    from benefitlens.operators.split import oof_region_rate, stratified_split
    return oof_region_rate(stratified_split(_eng(spark, sf)))


# --------------------------------------------------------------------------- metrics (stand-in score)
@query("metric_auc")
def q_metric_auc(spark, sf):
    from benefitlens.operators.metrics import auc
    return auc(_scored(spark, sf))


@query("metric_avg_precision")
def q_metric_avg_precision(spark, sf):
    from benefitlens.operators.metrics import average_precision
    return average_precision(_scored(spark, sf))


@query("metric_threshold")
def q_metric_threshold(spark, sf):
    from benefitlens.operators.metrics import threshold_metrics
    return threshold_metrics(_scored(spark, sf))


@query("metric_brier")
def q_metric_brier(spark, sf):
    from benefitlens.operators.metrics import brier
    return brier(_scored(spark, sf))


@query("metric_logloss")
def q_metric_logloss(spark, sf):
    from benefitlens.operators.metrics import log_loss
    return log_loss(_scored(spark, sf))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    from benefitlens.operators.metrics import confusion_matrix
    return confusion_matrix(_scored(spark, sf))


@query("classification_report")
def q_classification_report(spark, sf):
    from benefitlens.operators.metrics import classification_report
    return classification_report(_scored(spark, sf))


@query("naive_baselines")
def q_naive_baselines(spark, sf):
    from benefitlens.operators.metrics import naive_baselines
    return naive_baselines(_eng(spark, sf), "enrolled", "has_dependents_bin")


@query("precision_lift_at_k")
def q_precision_lift_at_k(spark, sf):
    from benefitlens.operators.metrics import precision_lift_at_k
    test = _split_scored(spark, sf).filter(F.col("split") == "test")
    return precision_lift_at_k(test, _reg(spark, sf))


@query("calibration_bins")
def q_calibration_bins(spark, sf):
    from benefitlens.operators.metrics import calibration_bins
    return calibration_bins(_scored(spark, sf))


# --------------------------------------------------------------------------- governance
LEAK_COLUMNS = ["legacy_propensity_score", "salary", "age", "tenure_years", "hist_enrollment_rate_region",
                "days_contact_to_app"]


@query("leakage_screen")
def q_leakage_screen(spark, sf):
    from benefitlens.operators.governance import leakage_screen
    return leakage_screen(_eng(spark, sf), LEAK_COLUMNS)


@query("leakage_screen_all")
def q_leakage_screen_all(spark, sf):
    """L1 over every numeric column, raw, joined-in and derived."""
    from benefitlens.operators.governance import leakage_screen
    from benefitlens.schemas import numeric_columns
    e = _eng(spark, sf)
    return leakage_screen(e, [c for c in numeric_columns(e) if c not in ("employee_id", "enrolled")])


@query("leakage_aggregate")
def q_leakage_aggregate(spark, sf):
    from benefitlens.operators.governance import leakage_aggregate
    from benefitlens.operators.split import stratified_split
    e = _eng(spark, sf)
    return leakage_aggregate(e, stratified_split(e))


def _requests(spark, sf):
    """Scoring requests derived from orders: one per order, for its customer."""
    from benefitlens.sources.tables import read_table
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey") % 5
    feat = (F.when(k == 0, F.lit("legacy_propensity_score"))
            .when(k == 1, F.lit("LEGACY_PROPENSITY_SCORE_v2"))
            .when(k == 2, F.lit("salary"))
            .when(k == 3, F.lit(None).cast("string"))
            .otherwise(F.lit("days_contact_to_app")))
    return o.select(F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("employee_id"),
                    feat.alias("feature_requested"))


@query("refuse_leakage")
def q_refuse_leakage(spark, sf):
    from benefitlens.operators.governance import refuse_leakage
    return refuse_leakage(_requests(spark, sf)).select("request_id", "employee_id", "feature_requested",
                                                       "status", "refusal_type")


@query("explain_drivers")
def q_explain_drivers(spark, sf):
    from benefitlens.operators.governance import reason_codes
    r = reason_codes(_dedup(spark, sf))
    x = r.select("employee_id", F.posexplode("top_drivers").alias("driver_pos", "d"))
    return x.select("employee_id", "driver_pos", "d.feature", "d.effect")


@query("explain_protected")
def q_explain_protected(spark, sf):
    from benefitlens.constants import PROTECTED_ATTRIBUTES
    from benefitlens.operators.governance import reason_codes
    r = reason_codes(_dedup(spark, sf))
    prot = F.array(*[F.lit(p) for p in PROTECTED_ATTRIBUTES])
    return r.select("employee_id", F.size("top_drivers").alias("n_drivers"),
                    F.exists("top_drivers", lambda d: F.array_contains(prot, d["feature"])).alias("has_protected"))


@query("explain_narrative")
def q_explain_narrative(spark, sf):
    from benefitlens.constants import FAIR_AI_NOTE
    from benefitlens.operators.governance import narrative, reason_codes
    s = _scored(spark, sf).select("employee_id", "p")
    r = reason_codes(_dedup(spark, sf)).join(s, "employee_id")
    return r.select("employee_id", F.round("p", 4).alias("enrollment_probability"),
                    (F.col("p") >= 0.5).cast("int").alias("predicted_enrolled"),
                    narrative(F.col("p"), F.col("employee_id")).alias("narrative_summary"),
                    F.to_json("top_drivers").alias("top_drivers"), F.lit(FAIR_AI_NOTE).alias("fair_ai_note"))


def _audit_frame(spark, sf):
    test = _split_scored(spark, sf).filter(F.col("split") == "test").select("employee_id", "p", "enrolled")
    demo = _dedup(spark, sf).select("employee_id", "gender", "age", "marital_status")
    return test.join(demo, "employee_id")


@query("fairness_audit")
def q_fairness_audit(spark, sf):
    from benefitlens.operators.governance import fairness_audit
    return fairness_audit(_audit_frame(spark, sf)).drop("gap")


@query("fairness_gap")
def q_fairness_gap(spark, sf):
    from benefitlens.operators.governance import fairness_audit
    return fairness_audit(_audit_frame(spark, sf)).select("dimension", "level", "actual_rate", "pred_rate", "gap")


# --------------------------------------------------------------------------- models (rows-only checks)
def _model_metrics(spark, sf, names):
    from benefitlens.plans.training import metrics_frame, train_and_evaluate
    e = _eng(spark, sf)
    return metrics_frame(spark, [train_and_evaluate(e, n) for n in names])


@query("train_logistic")
def q_train_logistic(spark, sf):
    return _model_metrics(spark, sf, ["logistic"])


@query("train_gbt_default")
def q_train_gbt_default(spark, sf):
    return _model_metrics(spark, sf, ["gbt_default"])


@query("train_gbt")
def q_train_gbt(spark, sf):
    return _model_metrics(spark, sf, ["gbt"])


@query("train_alt_trees")
def q_train_alt_trees(spark, sf):
    return _model_metrics(spark, sf, ["forest"])


@query("model_comparison")
def q_model_comparison(spark, sf):
    return _model_metrics(spark, sf, ["logistic", "gbt_default"])


@query("cross_validate")
def q_cross_validate(spark, sf):
    from benefitlens.plans.training import cross_validate
    e = _eng(spark, sf)
    return cross_validate(e, "gbt", "forest")


@query("sentinel_experiment")
def q_sentinel_experiment(spark, sf):
    from benefitlens.plans.probes import sentinel_experiment
    return sentinel_experiment(_eng(spark, sf))


@query("tree_probe")
def q_tree_probe(spark, sf):
    from benefitlens.plans.probes import tree_probe
    return tree_probe(_dedup(spark, sf))


@query("tree_depth_sweep")
def q_tree_depth_sweep(spark, sf):
    from benefitlens.plans.probes import tree_depth_sweep
    return tree_depth_sweep(_dedup(spark, sf))


@query("label_encode_all")
def q_label_encode_all(spark, sf):
    from benefitlens.operators.encode import label_encode_all
    return label_encode_all(_emp(spark, sf))


@query("forest_importance")
def q_forest_importance(spark, sf):
    from benefitlens.plans.probes import forest_importance
    return forest_importance(_emp(spark, sf))


@query("feature_importance")
def q_feature_importance(spark, sf):
    """Importances of the final boosted model, named and ranked."""
    from benefitlens.plans import modeling
    e = _eng(spark, sf)
    model = _model(spark, sf)
    _, names = modeling._stages_trees(modeling.prepare(e), modeling.EXPECTED_FEATURES)
    return modeling.feature_importance(model, names)


def _model(spark, sf):
    """The final boosted model (fitted once per input, then reloaded)."""
    from benefitlens.plans.training import final_model
    return final_model(spark, sf, _eng(spark, sf))


def _final_model(spark, sf):
    """The final model and its scores on the test split."""
    from benefitlens.plans import modeling
    from benefitlens.plans.training import final_test
    model = _model(spark, sf)
    return model, modeling.score(model, final_test(spark, sf, _eng(spark, sf)))


@query("score_batch")
def q_score_batch(spark, sf):
    """The final model scores arriving records through the shared C2 job."""
    from benefitlens.plans import modeling
    from benefitlens.plans.features import preprocess_scoring
    model = _model(spark, sf)
    feats = preprocess_scoring(_arriving_records(spark, sf), _reg(spark, sf))
    return modeling.score(model, modeling.prepare(feats))


@query("ablation")
def q_ablation(spark, sf):
    """Test AUC without demographics, with them, and with the leaky column."""
    from benefitlens.plans.training import ablation
    return ablation(_eng(spark, sf))


@query("score_reproducible")
def q_score_reproducible(spark, sf):
    """Two scorings of the same test rows agree."""
    from benefitlens.plans import modeling
    from benefitlens.plans.outreach import score_agreement
    from benefitlens.plans.training import final_test
    model = _model(spark, sf)
    test = final_test(spark, sf, _eng(spark, sf))
    return score_agreement(modeling.score(model, test), modeling.score(model, test))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """IO8: save the whole pipeline to the shared folder, reload, re-score."""
    import uuid
    from benefitlens.plans import modeling
    from benefitlens.plans.outreach import score_agreement
    from benefitlens.plans.training import final_test
    from benefitlens.session import shared_path
    model, scored = _final_model(spark, sf)
    loaded = modeling.save_and_reload(model, shared_path(spark, "models", uuid.uuid4().hex))
    return score_agreement(scored, modeling.score(loaded, final_test(spark, sf, _eng(spark, sf))))


@query("score_requests")
def q_score_requests(spark, sf):
    from benefitlens.plans.outreach import score_requests
    model = _model(spark, sf)
    return score_requests(model, _requests(spark, sf), _dedup(spark, sf), _reg(spark, sf))


@query("score_records")
def q_score_records(spark, sf):
    from benefitlens.plans.outreach import score_records
    model = _model(spark, sf)
    return score_records(model, _arriving_records(spark, sf), _reg(spark, sf))


# ------------------------------------------------- model-backed jobs, composed, and their deterministic parts
@query("score_batch_ids")
def q_score_batch_ids(spark, sf):
    return q_score_batch(spark, sf).select("employee_id", "reason")


@query("score_records_status")
def q_score_records_status(spark, sf):
    return q_score_records(spark, sf).select("employee_id", "status", "error")


@query("score_requests_status")
def q_score_requests_status(spark, sf):
    return q_score_requests(spark, sf).select("request_id", "employee_id", "status")


@query("explain_narrative_fields")
def q_explain_narrative_fields(spark, sf):
    return q_explain_narrative(spark, sf).select("employee_id", "enrollment_probability", "predicted_enrolled")


@query("io_json_parsed")
def q_io_json_parsed(spark, sf):
    """IO7 read back: the fields of the emitted JSON rows."""
    shape = "rank int, employee_id bigint, region string, enrollment_probability double, predicted_enrolled int"
    return q_io_json_rows(spark, sf).select(F.from_json("json", shape).alias("j")).select("j.*")


def _unique_records(spark, sf):
    e = _dedup(spark, sf).select("employee_id")
    return _arriving_records(spark, sf).join(e, "employee_id", "left_semi")


@query("rank_model")
def q_rank_model(spark, sf):
    """C2 -> M11 -> W6: outreach ranking on the fitted model's probabilities."""
    from benefitlens.plans.outreach import rank_scored
    model = _model(spark, sf)
    return rank_scored(model, _unique_records(spark, sf), _reg(spark, sf))[0]


@query("rank_model_summary")
def q_rank_model_summary(spark, sf):
    from benefitlens.plans.outreach import rank_scored
    model = _model(spark, sf)
    return rank_scored(model, _unique_records(spark, sf), _reg(spark, sf))[1]


@query("fairness_model")
def q_fairness_model(spark, sf):
    """M11 -> A13/L10: the fairness audit of the fitted model on the test split."""
    from benefitlens.plans.outreach import audit_scored
    _, scored = _final_model(spark, sf)
    return audit_scored(scored, _dedup(spark, sf))


@query("fairness_model_base")
def q_fairness_model_base(spark, sf):
    return q_fairness_model(spark, sf).select("dimension", "level", "count", "actual_rate")


@query("explain_model")
def q_explain_model(spark, sf):
    """L6-L8 on the fitted model's probabilities."""
    from benefitlens.plans.outreach import explain_scored
    model = _model(spark, sf)
    return explain_scored(model, _unique_records(spark, sf), _reg(spark, sf))


@query("explain_model_status")
def q_explain_model_status(spark, sf):
    """Status of each record, and whether its sentence tells the score's id, direction and percentage."""
    e = q_explain_model(spark, sf)
    p, text = F.col("enrollment_probability"), F.col("narrative_summary")
    pct = F.regexp_extract(text, r"([0-9.]+)%", 1).cast("double")
    likely = text.contains(" highly likely ")
    agrees = (text.startswith("Employee ") & (F.regexp_extract(text, r"^Employee (\d+) ", 1).cast("bigint") == F.col("employee_id"))
              & (F.abs(pct - p * 100) <= 0.01) & (likely == (F.col("predicted_enrolled") == 1)))
    return e.select("employee_id", "status", "error", agrees.alias("agrees"))


@query("precision_lift_model")
def q_precision_lift_model(spark, sf):
    """M21 of the fitted model on the test split."""
    from benefitlens.plans.outreach import lift_scored
    _, scored = _final_model(spark, sf)
    return lift_scored(scored, _dedup(spark, sf), _reg(spark, sf))


@query("precision_lift_model_counts")
def q_precision_lift_model_counts(spark, sf):
    return q_precision_lift_model(spark, sf).select("region", "n", "base_rate", "k")


# --------------------------------------------------------------------------- streaming
@query("stream_preprocess_scoring")
def q_stream_preprocess_scoring(spark, sf):
    """C2 run as a Structured Streaming query over records landed as files."""
    import uuid
    from benefitlens.session import shared_path
    from benefitlens.streaming.scoring import preprocess_stream, read_record_stream, run_available_now
    run = shared_path(spark, "stream", uuid.uuid4().hex)
    records = _arriving_records(spark, sf)
    records.write.mode("overwrite").parquet(f"{run}/landing")
    stream = read_record_stream(spark, f"{run}/landing", records.schema)
    run_available_now(preprocess_stream(stream, _reg(spark, sf)), f"{run}/out", f"{run}/_checkpoint")
    return spark.read.parquet(f"{run}/out")
