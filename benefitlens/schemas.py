"""Declared schemas (never inferred)."""

from pyspark.sql import types as T

EMP_SCHEMA = T.StructType([
    T.StructField("employee_id", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("marital_status", T.StringType()),
    T.StructField("salary", T.DoubleType()),
    T.StructField("employment_type", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("has_dependents", T.StringType()),
    T.StructField("tenure_years", T.DoubleType()),
    T.StructField("application_date", T.StringType()),
    T.StructField("last_contact_date", T.StringType()),
    T.StructField("last_contact_channel", T.StringType()),
    T.StructField("plan_tier_requested", T.StringType()),
    T.StructField("broker_channel", T.StringType()),
    T.StructField("prior_year_enrolled", T.IntegerType()),
    T.StructField("legacy_propensity_score", T.DoubleType()),
    T.StructField("outreach_notes", T.StringType()),
    T.StructField("enrolled", T.IntegerType()),
])

REGION_SCHEMA = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("n_employees_region", T.IntegerType()),
    T.StructField("hist_enrollment_rate_region", T.DoubleType()),
    T.StructField("avg_salary_region", T.DoubleType()),
    T.StructField("avg_premium_cost_usd", T.IntegerType()),
    T.StructField("benefits_broker_rating", T.DoubleType()),
    T.StructField("hr_outreach_capacity", T.IntegerType()),
    T.StructField("open_enrollment_window_days", T.IntegerType()),
    T.StructField("state_mandate_level", T.StringType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("employee_id", T.LongType()),
    T.StructField("feature_requested", T.StringType()),
])

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def text_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
