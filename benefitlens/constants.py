"""Names, domains and dictionaries used across the jobs (one copy only)."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's for identical results.
# Stated plainly, in the reference's natural order.
# ---------------------------------------------------------------------------

# Contact-channel dictionary (raw label -> canonical label). Exact, case-sensitive.
CHANNEL_MAP = {
    "EMAIL": "Email", "email": "Email", "e-mail": "Email", "Email": "Email",
    "PHONE": "Phone", "phone": "Phone", "Phone": "Phone", "Call": "Phone",
    "SMS": "SMS", "sms": "SMS", "Text": "SMS",
    "none": "Unknown",
}

# Plan-tier dictionary (raw label -> canonical label). Exact, case-sensitive.
TIER_MAP = {
    "STANDARD": "Standard", "Standard": "Standard", "standard": "Standard",
    "Silver": "Silver", "silver plan": "Silver",
    "Bronze": "Bronze",
    "BASIC": "Basic", "Basic": "Basic", "basic": "Basic",
    "premium plan": "Premium", "Premium": "Premium", "PREMIUM": "Premium",
    "gold": "Gold", "Gold Plan": "Gold", "Gold": "Gold",
}

# State mandate level dictionary; labels outside it stay null (no fill).
MANDATE_MAP = {"High": "High", "MED": "Medium", "low": "Low", "Low": "Low"}

# Model matrix, in order.
EXPECTED_FEATURES = [
    "salary", "employment_type", "region", "tenure_years",
    "hist_enrollment_rate_region", "avg_premium_cost_usd",
    "benefits_broker_rating", "hr_outreach_capacity",
    "open_enrollment_window_days", "state_mandate_level",
    "has_application_date", "days_contact_to_app", "contact_after_app",
    "no_prior_record", "prior_year_enrolled_clean",
    "last_contact_channel_clean", "plan_tier_requested_clean",
    "broker_channel_clean", "has_dependents_bin", "tenure_inconsistent",
]

REQUIRED_RAW_COLUMNS = ["region"]

# Fixed categorical domains; anything outside becomes null at scoring time.
CATEGORICAL_LEVELS = {
    "employment_type": ["Contract", "Full-time", "Part-time"],
    "region": ["Midwest", "Northeast", "South", "West"],
    "state_mandate_level": ["High", "Low", "Medium"],
    "last_contact_channel_clean": ["Email", "Phone", "SMS", "Unknown"],
    "plan_tier_requested_clean": ["Basic", "Bronze", "Gold", "Premium", "Silver", "Standard", "Unknown"],
    "broker_channel_clean": ["Direct", "Employer-Sponsored", "Third-Party", "Unknown"],
}

# Defaults for raw columns absent from a partial scoring input (None = null).
SCORING_DEFAULTS = {
    "age": None, "gender": "Unknown", "marital_status": "Unknown",
    "salary": None, "employment_type": "Unknown", "has_dependents": "No",
    "tenure_years": None, "prior_year_enrolled": -1,
    "application_date": None, "last_contact_date": None,
    "last_contact_channel": None, "plan_tier_requested": None,
    "broker_channel": None,
}

# Candidate features before the leakage review.
CANDIDATE_FEATURES = [
    "age", "gender", "marital_status",
    "salary", "employment_type", "region",
    "has_dependents_bin", "tenure_years", "tenure_inconsistent",
    "no_prior_record", "prior_year_enrolled_clean",
    "last_contact_channel_clean", "broker_channel_clean",
    "plan_tier_requested_clean",
    "has_application_date", "days_contact_to_app", "contact_after_app",
    "hist_enrollment_rate_region", "avg_premium_cost_usd",
    "benefits_broker_rating", "hr_outreach_capacity",
    "open_enrollment_window_days", "state_mandate_level",
    "outreach_notes",
]

# Columns excluded before model training (feature register).
EXCLUDED_FEATURES = [
    "employee_id", "enrolled",
    "application_date", "last_contact_date",
    "app_date", "contact_date",
    "prior_year_enrolled", "has_dependents",
    "last_contact_channel", "plan_tier_requested", "broker_channel",
    "legacy_propensity_score",
    "n_employees_region", "avg_salary_region",
]

# Columns dropped when the processed table is written.
SPLIT_DROP_COLUMNS = [
    "employee_id", "application_date", "last_contact_date",
    "app_date", "contact_date", "prior_year_enrolled", "has_dependents",
    "last_contact_channel", "plan_tier_requested", "broker_channel",
    "legacy_propensity_score", "n_employees_region", "avg_salary_region",
    "outreach_notes", "age", "gender", "marital_status",
]

LEAKY_COLUMN = "legacy_propensity_score"
PROTECTED_ATTRIBUTES = ["gender", "marital_status", "age"]

# Prompt screening: whole-word medical terms, then discrimination patterns.
MEDICAL_KEYWORDS = [
    "diagnose", "diagnosis", "treatment", "medical advice", "doctor",
    "prescription", "illness", "disease", "condition", "therapy",
    "symptom", "cure", "medication", "diabetes", "cancer",
]
DISCRIMINATION_PATTERNS = [
    r"filter out (female|male|women|men|other gender)",
    r"exclude (female|male|women|men|other gender)",
    r"deny (female|male|women|men|other gender)",
    r"only hire (female|male|women|men)",
    r"discriminate",
]

LEAKAGE_REFUSAL_MESSAGE = (
    "REFUSAL: legacy_propensity_score is excluded from model inputs due to critical "
    "target leakage (AUC = 1.0, correlation = 0.9764)."
)
MEDICAL_REFUSAL_MESSAGE = (
    "REFUSAL: I am an AI insurance enrollment assistant and cannot provide medical advice, "
    "clinical diagnoses, or specific plan treatment recommendations. "
    "Please consult a licensed healthcare provider or your HR Benefits Specialist."
)
DISCRIMINATION_REFUSAL_MESSAGE = (
    "REFUSAL: I cannot perform filtering or ranking designed to exclude or deny benefits "
    "based on protected demographic characteristics (e.g., gender). All benefit enrollment "
    "recommendations must adhere to corporate non-discrimination policies and Fair AI standards."
)
FAIR_AI_NOTE = (
    "Explanations strictly exclude protected attributes (gender, marital_status, age) "
    "per corporate non-discrimination policy."
)

# Reason-code texts of the rule-based explanation ({} = formatted value).
REASON_DEPENDENTS_YES = "Has dependents (+1), strongly increasing benefit enrollment likelihood."
REASON_DEPENDENTS_NO = "No dependents recorded, associated with lower enrollment propensity."
REASON_SALARY_HIGH = "Annual salary (${}) is in the higher tier (>= $60,000), supporting benefit affordability."
REASON_SALARY_LOW = "Annual salary (${}) is below $60,000 threshold, increasing cost sensitivity."
REASON_FULL_TIME = "Full-time employment status increases benefit participation."
REASON_OTHER_TYPE = "{} status decreases baseline enrollment probability."
REASON_PRIOR_YES = "Enrolled in prior year plan (strong historical retention signal)."
REASON_PRIOR_NO = "Opted out of enrollment in prior year."
REASON_HIGH_TIER = "Requested high-coverage plan tier ({}), indicating strong active interest."
HIGH_COVERAGE_TIERS = ["Gold", "Premium", "Silver"]
SALARY_THRESHOLD = 60000.0

# pandas' default read_csv null tokens (public pandas documentation); note that
# the lower-case word 'none' is NOT one of them and stays a data value.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Age bands, right-closed: (20, 35], (35, 50], (50, 65].
AGE_BANDS = [(20, 35, "20-35"), (35, 50, "36-50"), (50, 65, "51-65")]

# Split parameters.
SPLIT_SEED = 42
TEST_FRACTION_DENOMINATOR = 5   # test = ceil(n / 5), i.e. 20%
N_FOLDS = 5
