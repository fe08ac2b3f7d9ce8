"""DuckDB oracle texts for the value check (independent SQL formulations).

Every text starts from the same fixture views the Spark side derives; the
operators themselves are re-stated in plain SQL, not generated from Spark.
Integer outputs are BIGINT and floating outputs are rounded to 6 places on
both sides.
"""

from __future__ import annotations

from benefitlens.sources.fixtures import duckdb_fixture_ctes

_ISO_FORMATS = "'%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y%m%d'"
APP_FORMATS = f"[{_ISO_FORMATS}, '%d/%m/%y', '%m/%d/%y', '%d/%m/%Y', '%m/%d/%Y', '%d-%m-%Y', '%m-%d-%Y', '%B %d, %Y']"
CONTACT_FORMATS = f"[{_ISO_FORMATS}, '%m/%d/%y', '%d/%m/%y', '%m/%d/%Y', '%d/%m/%Y', '%m-%d-%Y', '%d-%m-%Y', '%B %d, %Y']"

BASE = """
emp AS (SELECT * REPLACE (CAST(employee_id AS BIGINT) AS employee_id, CAST(age AS BIGINT) AS age,
          CAST(prior_year_enrolled AS BIGINT) AS prior_year_enrolled, CAST(enrolled AS BIGINT) AS enrolled)
        FROM emp_raw),
reg AS (SELECT * REPLACE (CAST(n_employees_region AS BIGINT) AS n_employees_region,
          CAST(avg_premium_cost_usd AS BIGINT) AS avg_premium_cost_usd,
          CAST(hr_outreach_capacity AS BIGINT) AS hr_outreach_capacity,
          CAST(open_enrollment_window_days AS BIGINT) AS open_enrollment_window_days)
        FROM region_profile),
dedup AS (SELECT * FROM emp WHERE employee_id IN
          (SELECT employee_id FROM emp GROUP BY employee_id HAVING count(*) = 1)),
regc AS (SELECT * REPLACE (CASE state_mandate_level WHEN 'High' THEN 'High' WHEN 'MED' THEN 'Medium'
          WHEN 'low' THEN 'Low' WHEN 'Low' THEN 'Low' END AS state_mandate_level) FROM reg),
eng AS (ENG_DEDUP),
scored AS (SELECT employee_id, region, employment_type, enrolled,
    0.05e0 + (CASE WHEN has_dependents = 'Yes' THEN 0.45e0 ELSE 0e0 END)
           + (CASE WHEN salary >= 60000e0 THEN 0.25e0 ELSE 0e0 END)
           + (CASE WHEN employment_type = 'Full-time' THEN 0.1e0 ELSE 0e0 END)
           + (employee_id % 10) / 100e0 AS p
  FROM dedup),
ranked AS (SELECT employee_id, enrolled,
    row_number() OVER (PARTITION BY enrolled ORDER BY md5('42:' || CAST(employee_id AS VARCHAR))) - 1 AS class_rank
  FROM dedup),
cls AS (SELECT enrolled, count(*) AS n_c FROM dedup GROUP BY enrolled),
tot AS (SELECT CAST(sum(n_c) AS BIGINT) AS n, CAST(ceil(sum(n_c) / 5e0) AS BIGINT) AS nt FROM cls),
alloc0 AS (SELECT c.enrolled, (t.nt * c.n_c) // t.n AS base, (t.nt * c.n_c) % t.n AS rem, t.nt
  FROM cls c, tot t),
alloc AS (SELECT enrolled, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, enrolled)
    <= nt - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM alloc0),
splits AS (SELECT r.employee_id, r.enrolled, CAST(r.class_rank AS BIGINT) AS class_rank,
    CASE WHEN r.class_rank < a.n_test THEN 'test' ELSE 'train' END AS split,
    CAST(r.class_rank % 5 AS BIGINT) AS fold
  FROM ranked r JOIN alloc a ON r.enrolled = a.enrolled)
"""


def eng_sql(src: str) -> str:
    """The feature job restated in SQL over any raw-shaped relation ``src``."""
    return f"""SELECT * EXCLUDE (app_ts, contact_ts), CAST(app_ts AS DATE) AS app_date, CAST(contact_ts AS DATE) AS contact_date,
    CAST(app_ts IS NOT NULL AS BIGINT) AS has_application_date,
    CAST(floor((epoch(app_ts) - epoch(contact_ts)) / 86400) AS BIGINT) AS days_contact_to_app,
    CAST(coalesce(contact_ts > app_ts, false) AS BIGINT) AS contact_after_app,
    CAST(coalesce(prior_year_enrolled = -1, false) AS BIGINT) AS no_prior_record,
    CAST(coalesce(prior_year_enrolled = 1, false) AS BIGINT) AS prior_year_enrolled_clean,
    coalesce(CASE last_contact_channel WHEN 'EMAIL' THEN 'Email' WHEN 'email' THEN 'Email'
      WHEN 'e-mail' THEN 'Email' WHEN 'Email' THEN 'Email' WHEN 'PHONE' THEN 'Phone'
      WHEN 'phone' THEN 'Phone' WHEN 'Phone' THEN 'Phone' WHEN 'Call' THEN 'Phone'
      WHEN 'SMS' THEN 'SMS' WHEN 'sms' THEN 'SMS' WHEN 'Text' THEN 'SMS'
      WHEN 'none' THEN 'Unknown' END, 'Unknown') AS last_contact_channel_clean,
    coalesce(CASE plan_tier_requested WHEN 'STANDARD' THEN 'Standard' WHEN 'Standard' THEN 'Standard'
      WHEN 'standard' THEN 'Standard' WHEN 'Silver' THEN 'Silver' WHEN 'silver plan' THEN 'Silver'
      WHEN 'Bronze' THEN 'Bronze' WHEN 'BASIC' THEN 'Basic' WHEN 'Basic' THEN 'Basic'
      WHEN 'basic' THEN 'Basic' WHEN 'premium plan' THEN 'Premium' WHEN 'Premium' THEN 'Premium'
      WHEN 'PREMIUM' THEN 'Premium' WHEN 'gold' THEN 'Gold' WHEN 'Gold Plan' THEN 'Gold'
      WHEN 'Gold' THEN 'Gold' END, 'Unknown') AS plan_tier_requested_clean,
    coalesce(broker_channel, 'Unknown') AS broker_channel_clean,
    CAST(coalesce(has_dependents = 'Yes', false) AS BIGINT) AS has_dependents_bin,
    CAST(coalesce(tenure_years > age - 18, false) AS BIGINT) AS tenure_inconsistent
  FROM (SELECT d.*, r.n_employees_region, r.hist_enrollment_rate_region, r.avg_salary_region,
          r.avg_premium_cost_usd, r.benefits_broker_rating, r.hr_outreach_capacity,
          r.open_enrollment_window_days, r.state_mandate_level,
          try_strptime(trim(d.application_date), {APP_FORMATS}) AS app_ts,
          try_strptime(trim(d.last_contact_date), {CONTACT_FORMATS}) AS contact_ts
        FROM {src} d LEFT JOIN regc r ON d.region = r.region) e0"""


BASE = BASE.replace("ENG_DEDUP", eng_sql("dedup"))

HEAD = "WITH " + duckdb_fixture_ctes() + "," + BASE


def wrap(body: str, ints=(), floats=(), dates=()) -> str:
    """Fixture + shared CTEs + body; listed columns normalised in a final REPLACE."""
    sql = HEAD + "\n" + body
    repl = [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    repl += [f"ROUND(CAST({c} AS DOUBLE), 6) AS {c}" for c in floats]
    repl += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) q"


def nulls_union(table: str, cols, name="column_name", value="null_count") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS {name}, CAST(count(*) - count({c}) AS BIGINT) AS {value} FROM {table}" for c in cols)


ORACLE: dict[str, str] = {}


def oracle(name, body, ints=(), floats=(), dates=()):
    ORACLE[name] = wrap(body, ints, floats, dates)


# --------------------------------------------------------------------------- ranking
oracle("rank_capacity", """
SELECT s.region, s.rank, s.employee_id, s.employment_type, s.enrolled, s.p, r.capacity
FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p DESC, employee_id) AS rank FROM scored) s
LEFT JOIN (SELECT region, hr_outreach_capacity AS capacity FROM reg) r ON s.region = r.region
WHERE r.capacity IS NULL OR s.rank <= r.capacity
""", floats=["p"])

# --------------------------------------------------------------------------- sources
EMP_FLOATS = ["salary", "tenure_years", "legacy_propensity_score"]
REG_FLOATS = ["hist_enrollment_rate_region", "avg_salary_region", "benefits_broker_rating"]

oracle("io_read_raw", "SELECT * REPLACE (CASE WHEN outreach_notes NOT IN ('NA', 'n/a') THEN outreach_notes END AS outreach_notes) FROM emp",
       floats=EMP_FLOATS)
oracle("io_read_region", "SELECT * FROM reg", floats=REG_FLOATS)
oracle("io_validate_records", """
SELECT employee_id, region,
  CASE WHEN region IS NULL THEN 'missing_region'
       WHEN NOT EXISTS (SELECT 1 FROM reg r WHERE r.region = x.region) THEN 'unknown_region' END AS reason
FROM (SELECT employee_id, CASE WHEN employee_id % 50 = 0 THEN NULL WHEN employee_id % 50 = 1 THEN lower(region)
        ELSE region END AS region FROM emp) x
""")
oracle("default_columns", """
SELECT employee_id, region, age, salary, 'Unknown' AS gender, 'Unknown' AS marital_status,
  'Unknown' AS employment_type, 'No' AS has_dependents, CAST(NULL AS DOUBLE) AS tenure_years,
  CAST(-1 AS BIGINT) AS prior_year_enrolled, CAST(NULL AS VARCHAR) AS application_date,
  CAST(NULL AS VARCHAR) AS last_contact_date, CAST(NULL AS VARCHAR) AS last_contact_channel,
  CAST(NULL AS VARCHAR) AS plan_tier_requested, CAST(NULL AS VARCHAR) AS broker_channel
FROM emp
""", floats=["salary", "tenure_years"])
oracle("io_read_split", """
SELECT e.employee_id, e.enrolled, e.region, e.salary, s.split
FROM eng e JOIN splits s ON e.employee_id = s.employee_id WHERE s.split = 'test'
""", floats=["salary"])
oracle("head_n", "SELECT employee_id, region, salary FROM eng ORDER BY employee_id LIMIT 10", floats=["salary"])

# --------------------------------------------------------------------------- projections / filters
FEATURES = ["salary", "employment_type", "region", "tenure_years", "hist_enrollment_rate_region",
            "avg_premium_cost_usd", "benefits_broker_rating", "hr_outreach_capacity",
            "open_enrollment_window_days", "state_mandate_level", "has_application_date",
            "days_contact_to_app", "contact_after_app", "no_prior_record", "prior_year_enrolled_clean",
            "last_contact_channel_clean", "plan_tier_requested_clean", "broker_channel_clean",
            "has_dependents_bin", "tenure_inconsistent"]
FEATURE_FLOATS = ["salary", "tenure_years", "hist_enrollment_rate_region", "benefits_broker_rating"]

oracle("feature_matrix", f"SELECT employee_id, {', '.join(FEATURES)} FROM eng", floats=FEATURE_FLOATS)
oracle("exclude_columns", """
SELECT * EXCLUDE (employee_id, application_date, last_contact_date, app_date, contact_date,
  prior_year_enrolled, has_dependents, last_contact_channel, plan_tier_requested, broker_channel,
  legacy_propensity_score, n_employees_region, avg_salary_region, outreach_notes, age, gender,
  marital_status) FROM eng
""", floats=FEATURE_FLOATS)

_CAND = ["age", "gender", "marital_status", "salary", "employment_type", "region", "has_dependents_bin",
         "tenure_years", "tenure_inconsistent", "no_prior_record", "prior_year_enrolled_clean",
         "last_contact_channel_clean", "broker_channel_clean", "plan_tier_requested_clean",
         "has_application_date", "days_contact_to_app", "contact_after_app", "hist_enrollment_rate_region",
         "avg_premium_cost_usd", "benefits_broker_rating", "hr_outreach_capacity",
         "open_enrollment_window_days", "state_mandate_level", "outreach_notes"]
_EXCL = ["employee_id", "enrolled", "application_date", "last_contact_date", "app_date", "contact_date",
         "prior_year_enrolled", "has_dependents", "last_contact_channel", "plan_tier_requested",
         "broker_channel", "legacy_propensity_score", "n_employees_region", "avg_salary_region"]
_REG_ROWS = ", ".join([f"('{c}', 'candidate', {i})" for i, c in enumerate(_CAND)]
                      + [f"('{c}', 'excluded', {i})" for i, c in enumerate(_EXCL)])
oracle("feature_register", f"""
, nulls AS ({nulls_union('eng', list(dict.fromkeys(_CAND + _EXCL)))})
SELECT r.column_name, r.role, r.position, n.null_count
FROM (VALUES {_REG_ROWS}) r(column_name, role, position) LEFT JOIN nulls n ON r.column_name = n.column_name
""".replace("\n, nulls AS", "\nSELECT * FROM (WITH nulls AS", 1).rstrip() + ")", ints=["position"])
oracle("filter_eq", "SELECT employee_id, legacy_propensity_score FROM eng WHERE enrolled = 1",
       floats=["legacy_propensity_score"])
oracle("filter_ci", "SELECT employee_id, region FROM dedup WHERE lower(region) = 'west'")
oracle("filter_isin", """
SELECT employee_id, region, salary FROM dedup
WHERE employee_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""", floats=["salary"])
oracle("filter_notnull", """
SELECT employee_id, application_date, legacy_propensity_score FROM dedup
WHERE application_date IS NOT NULL AND legacy_propensity_score IS NOT NULL
""", floats=["legacy_propensity_score"])
oracle("filter_range", """
SELECT employee_id, age, salary, employment_type, tenure_years FROM emp WHERE salary < 15000e0
""", floats=["salary", "tenure_years"])
oracle("sentinel_long_tenure", """
SELECT employee_id, tenure_years FROM dedup WHERE prior_year_enrolled = -1 AND tenure_years >= 1e0
""", floats=["tenure_years"])
oracle("messy_rows", """
SELECT employee_id FROM eng WHERE has_application_date = 0 OR contact_after_app = 1 OR tenure_inconsistent = 1
  OR no_prior_record = 1 OR last_contact_channel_clean = 'Unknown' OR plan_tier_requested_clean = 'Unknown'
""")
oracle("date_format_profile", """
SELECT CAST(count(*) AS BIGINT) AS slash_rows,
  max(TRY_CAST(split_part(application_date, '/', 1) AS INT)) AS max_first,
  max(TRY_CAST(split_part(application_date, '/', 2) AS INT)) AS max_second,
  CAST(count(*) FILTER (WHERE TRY_CAST(split_part(application_date, '/', 1) AS INT) > 12) AS BIGINT) AS first_gt_12,
  CAST(count(*) FILTER (WHERE TRY_CAST(split_part(application_date, '/', 2) AS INT) > 12) AS BIGINT) AS second_gt_12
FROM emp WHERE application_date IS NOT NULL AND contains(application_date, '/')
""", ints=["max_first", "max_second"])

# --------------------------------------------------------------------------- joins
oracle("join_region", """
SELECT d.employee_id, d.region, r.hist_enrollment_rate_region, r.hr_outreach_capacity, r.state_mandate_level
FROM dedup d LEFT JOIN regc r ON d.region = r.region
""", floats=["hist_enrollment_rate_region"])
oracle("join_cardinality", """
SELECT rows_before, rows_after, dim_key_unique, rows_before = rows_after AS cardinality_ok FROM (
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM dedup) AS rows_before,
         (SELECT CAST(count(*) AS BIGINT) FROM dedup d LEFT JOIN reg r ON d.region = r.region) AS rows_after,
         (SELECT count(*) = count(DISTINCT region) FROM reg) AS dim_key_unique)
""")
oracle("join_unmatched", """
SELECT 'fact_only' AS side, region FROM (SELECT DISTINCT region FROM dedup) f
WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.region = f.region)
UNION ALL
SELECT 'dimension_only' AS side, region FROM (SELECT DISTINCT region FROM reg) g
WHERE NOT EXISTS (SELECT 1 FROM dedup d WHERE d.region = g.region)
""")
oracle("join_scores_back", """
SELECT d.employee_id, d.age, d.salary, d.region, s.p FROM dedup d JOIN scored s ON d.employee_id = s.employee_id
""", floats=["salary", "p"])
oracle("reconcile_region", """
SELECT coalesce(c.region, p.region) AS region, c.count_actual, c.avg_salary_actual, c.rate_actual,
  p.count_published, p.avg_salary_published, p.rate_published,
  abs(c.count_actual - p.count_published) AS count_diff,
  abs(c.avg_salary_actual - p.avg_salary_published) AS avg_salary_diff,
  abs(c.rate_actual - p.rate_published) AS rate_diff
FROM (SELECT region, CAST(count(employee_id) AS DOUBLE) AS count_actual, round(avg(salary), 2) AS avg_salary_actual,
        avg(CAST(enrolled AS DOUBLE)) AS rate_actual FROM eng GROUP BY region) c
FULL OUTER JOIN (SELECT region, CAST(n_employees_region AS DOUBLE) AS count_published,
        CAST(avg_salary_region AS DOUBLE) AS avg_salary_published,
        CAST(hist_enrollment_rate_region AS DOUBLE) AS rate_published FROM reg) p ON c.region = p.region
""", floats=["count_actual", "avg_salary_actual", "rate_actual", "count_published", "avg_salary_published",
             "rate_published", "count_diff", "avg_salary_diff", "rate_diff"])
oracle("join_scores_raw", """
SELECT e.employee_id, e.salary, e.region, m.mean_salary FROM emp e LEFT JOIN
  (SELECT employee_id, round(avg(salary), 2) AS mean_salary FROM emp GROUP BY employee_id) m ON e.employee_id = m.employee_id
""", floats=["salary", "mean_salary"])
oracle("audit_join", """
SELECT s.employee_id, s.p, s.enrolled, d.gender, d.age, d.marital_status
FROM splits sp JOIN scored s ON sp.employee_id = s.employee_id JOIN dedup d ON d.employee_id = s.employee_id
WHERE sp.split = 'test'
""", floats=["p"])
oracle("join_null_report", nulls_union("eng", [
    "n_employees_region", "hist_enrollment_rate_region", "avg_salary_region", "avg_premium_cost_usd",
    "benefits_broker_rating", "hr_outreach_capacity", "open_enrollment_window_days", "state_mandate_level"]))


def case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"


CHANNEL = {"EMAIL": "Email", "email": "Email", "e-mail": "Email", "Email": "Email", "PHONE": "Phone",
           "phone": "Phone", "Phone": "Phone", "Call": "Phone", "SMS": "SMS", "sms": "SMS", "Text": "SMS",
           "none": "Unknown"}
TIER = {"STANDARD": "Standard", "Standard": "Standard", "standard": "Standard", "Silver": "Silver",
        "silver plan": "Silver", "Bronze": "Bronze", "BASIC": "Basic", "Basic": "Basic", "basic": "Basic",
        "premium plan": "Premium", "Premium": "Premium", "PREMIUM": "Premium", "gold": "Gold",
        "Gold Plan": "Gold", "Gold": "Gold"}
MANDATE = {"High": "High", "MED": "Medium", "low": "Low", "Low": "Low"}
DESC = ["count", "mean", "std", "min", "max", "q25", "q50", "q75"]
DESC_FLOATS = DESC[1:]


def describe_sql(expr: str) -> str:
    return (f"CAST(count({expr}) AS BIGINT) AS count, avg({expr}) AS mean, stddev_samp({expr}) AS std, "
            f"min({expr}) AS min, max({expr}) AS max, quantile_cont({expr}, 0.25) AS q25, "
            f"quantile_cont({expr}, 0.5) AS q50, quantile_cont({expr}, 0.75) AS q75")


# --------------------------------------------------------------------------- aggregates / profiles
_EMP_TYPES = [("employee_id", "bigint"), ("age", "int"), ("gender", "string"), ("marital_status", "string"),
              ("salary", "double"), ("employment_type", "string"), ("region", "string"),
              ("has_dependents", "string"), ("tenure_years", "double"), ("application_date", "string"),
              ("last_contact_date", "string"), ("last_contact_channel", "string"),
              ("plan_tier_requested", "string"), ("broker_channel", "string"), ("prior_year_enrolled", "int"),
              ("legacy_propensity_score", "double"), ("outreach_notes", "string"), ("enrolled", "int")]
_EMP_COLS = [c for c, _ in _EMP_TYPES]
_EMP_TEXT = [c for c, t in _EMP_TYPES if t == "string"]
_EMP_NUM = [c for c, t in _EMP_TYPES if t != "string"]

oracle("profile_table", "\nUNION ALL\n".join(
    f"SELECT (SELECT count(*) FROM emp) AS n_rows, 18 AS n_cols, {i} AS position, '{c}' AS column_name, "
    f"'{t}' AS data_type, '{'text' if t == 'string' else 'numeric'}' AS kind, count({c}) AS non_null FROM emp"
    for i, (c, t) in enumerate(_EMP_TYPES)), ints=["n_rows", "n_cols", "position", "non_null"])
oracle("missing_profile", f"""
SELECT column_name, null_count, null_count * 100e0 / (SELECT count(*) FROM dedup) AS null_pct
FROM ({nulls_union('dedup', _EMP_COLS)}) x WHERE null_count > 0
""", floats=["null_pct"])
oracle("describe_numeric", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {describe_sql(f'CAST({c} AS DOUBLE)')} FROM emp" for c in _EMP_NUM),
    floats=DESC_FLOATS)
oracle("describe_by_group", f"""
SELECT enrolled, {describe_sql('legacy_propensity_score')} FROM dedup WHERE enrolled IS NOT NULL GROUP BY enrolled
""", floats=DESC_FLOATS)
oracle("value_counts", """
SELECT last_contact_channel, CAST(count(*) AS BIGINT) AS count FROM dedup GROUP BY last_contact_channel
""")
oracle("value_counts_norm", """
SELECT prior_year_enrolled, CAST(count(*) AS BIGINT) AS count,
  count(*) / (SELECT count(*) FROM dedup) AS proportion FROM dedup GROUP BY prior_year_enrolled
""", floats=["proportion"])
_LONG = "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {c} AS value FROM emp" for c in _EMP_TEXT)
oracle("cardinality_top5", f"""
, counts AS (SELECT column_name, value, count(*) AS count FROM ({_LONG}) l GROUP BY column_name, value),
card AS (SELECT column_name, count(*) AS n_unique FROM counts WHERE value IS NOT NULL GROUP BY column_name)
SELECT c.column_name, c.value, c.count, c.rank, d.n_unique FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC NULLS FIRST) AS rank
  FROM counts) c LEFT JOIN card d ON c.column_name = d.column_name WHERE c.rank <= 5
""", ints=["count", "rank", "n_unique"])
_WIDE = "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM events" for c in ("user_id", "event_type", "props"))
oracle("top_values_wide", f"""
, long AS ({_WIDE}), counts AS (SELECT column_name, value, count(*) AS count FROM long GROUP BY column_name, value)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC NULLS FIRST) AS rank FROM counts)
WHERE rank <= 5
""", ints=["count", "rank"])
oracle("cardinality_approx", f"""
, long AS ({_WIDE}) SELECT column_name, CAST(count(DISTINCT value) AS BIGINT) AS n_exact, true AS within FROM long GROUP BY column_name
""")
oracle("distinct_levels", """
SELECT DISTINCT plan_tier_requested_clean FROM eng WHERE plan_tier_requested_clean IS NOT NULL
""")
oracle("rate_by_group", """
SELECT prior_year_enrolled, avg(CAST(enrolled AS DOUBLE)) AS rate, CAST(count(*) AS BIGINT) AS n
FROM dedup WHERE prior_year_enrolled IS NOT NULL GROUP BY prior_year_enrolled
""", floats=["rate"])
oracle("rate_by_sentinel_pair", """
SELECT no_prior_record, prior_year_enrolled_clean, avg(CAST(enrolled AS DOUBLE)) AS rate, CAST(count(*) AS BIGINT) AS n
FROM eng GROUP BY no_prior_record, prior_year_enrolled_clean
""", floats=["rate"])
oracle("count_by_group", """
SELECT region, CAST(count(employee_id) AS BIGINT) AS count FROM eng WHERE region IS NOT NULL GROUP BY region
""")
oracle("first_by_group", """
SELECT region, min(hist_enrollment_rate_region) AS value,
  min(hist_enrollment_rate_region) IS NOT DISTINCT FROM max(hist_enrollment_rate_region) AS is_constant
FROM eng WHERE region IS NOT NULL GROUP BY region
""", floats=["value"])
oracle("crosstab", """
SELECT quality, CAST(count(*) FILTER (WHERE toxic = 0) AS BIGINT) AS toxic_0,
  CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS toxic_1 FROM labels GROUP BY quality
""", ints=["quality"])
oracle("crosstab_margins", """
SELECT CASE WHEN grouping(h) = 1 THEN 'All' ELSE CAST(h AS VARCHAR) END AS has_application_date,
  CASE WHEN grouping(enrolled) = 1 THEN 'All' ELSE CAST(enrolled AS VARCHAR) END AS enrolled,
  CAST(count(*) AS BIGINT) AS count
FROM (SELECT application_date IS NOT NULL AS h, enrolled FROM emp) x GROUP BY CUBE (h, enrolled)
""")
oracle("crosstab_rowpct", """
SELECT coalesce(plan_tier_requested, 'Missing') AS plan_tier_requested,
  count(*) FILTER (WHERE enrolled = 0) / count(*) AS enrolled_0,
  count(*) FILTER (WHERE enrolled = 1) / count(*) AS enrolled_1
FROM emp GROUP BY coalesce(plan_tier_requested, 'Missing')
""", floats=["enrolled_0", "enrolled_1"])
oracle("corr_target", """
SELECT 'legacy_propensity_score' AS column_name, corr(legacy_propensity_score, enrolled) AS corr FROM eng
UNION ALL SELECT 'hist_enrollment_rate_region', corr(hist_enrollment_rate_region, enrolled) FROM eng
""", floats=["corr"])
oracle("corr_all_target", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, corr(CAST({c} AS DOUBLE), CAST(enrolled AS DOUBLE)) AS corr FROM emp"
    for c in ["age", "salary", "tenure_years", "prior_year_enrolled", "legacy_propensity_score"]), floats=["corr"])
_MISS = ["application_date", "last_contact_channel", "plan_tier_requested", "broker_channel",
         "legacy_propensity_score", "outreach_notes"]
oracle("missing_corr", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, corr(CAST({c} IS NULL AS DOUBLE), CAST(enrolled AS DOUBLE)) AS corr FROM dedup"
    for c in _MISS), floats=["corr"])
oracle("missing_cooccur", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, CAST(count(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS BIGINT)"
    f" AS both_missing FROM dedup" for a in _MISS[:4] for b in _MISS[:4] if a < b))
oracle("quantiles", "\nUNION ALL\n".join(
    f"SELECT {q}e0 AS prob, quantile_cont(salary, {q}) AS value FROM emp"
    for q in ["0.001", "0.005", "0.01", "0.05", "0.1", "0.5"]), floats=["prob", "value"])
oracle("chronology_stats", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE app_date IS NULL) AS BIGINT) AS null_app_date,
  CAST(count(*) FILTER (WHERE contact_date IS NULL) AS BIGINT) AS null_contact_date,
  CAST(count(days_contact_to_app) AS BIGINT) AS both_dates,
  CAST(count(*) FILTER (WHERE days_contact_to_app < 0) AS BIGINT) AS contact_after_app,
  min(CASE WHEN days_contact_to_app < 0 THEN days_contact_to_app END) AS min_negative_days,
  max(CASE WHEN days_contact_to_app < 0 THEN days_contact_to_app END) AS max_negative_days,
  CASE WHEN count(days_contact_to_app) > 0 THEN
    count(*) FILTER (WHERE days_contact_to_app < 0) * 100e0 / count(days_contact_to_app) END AS pct_after,
  avg(CASE WHEN days_contact_to_app >= 0 THEN CAST(enrolled AS DOUBLE) END) AS rate_in_order,
  avg(CASE WHEN days_contact_to_app < 0 THEN CAST(enrolled AS DOUBLE) END) AS rate_after
FROM eng
""", floats=["pct_after", "rate_in_order", "rate_after"])
oracle("date_parse_failures", f"""
SELECT 'application_date' AS column_name, employee_id, application_date AS raw_value FROM emp
WHERE application_date IS NOT NULL AND try_strptime(trim(application_date), {APP_FORMATS}) IS NULL
UNION ALL
SELECT 'last_contact_date', employee_id, last_contact_date FROM emp
WHERE last_contact_date IS NOT NULL AND try_strptime(trim(last_contact_date), {CONTACT_FORMATS}) IS NULL
""")
oracle("start_age_profile", f"""
SELECT {describe_sql('CAST(age - tenure_years AS DOUBLE)')},
  CAST(count(*) FILTER (WHERE age - tenure_years < 18) AS BIGINT) AS under_18 FROM emp
""", floats=DESC_FLOATS)
_OTHER = [c for c in _EMP_COLS if c != "employee_id"]
_DIFF = ",\n  ".join(f"(count(DISTINCT {c}) > 1 OR (count({c}) > 0 AND count({c}) < count(*))) AS d_{c}"
                     for c in _OTHER)
oracle("duplicate_conflicts", f"""
, g AS (SELECT employee_id, CAST(count(*) AS BIGINT) AS n_rows, {_DIFF},
  array_to_string(list_sort(list_distinct(list(CAST(enrolled AS VARCHAR)))), ',') AS label_values
  FROM emp WHERE employee_id IN (SELECT employee_id FROM emp GROUP BY employee_id HAVING count(*) > 1)
  GROUP BY employee_id)
SELECT employee_id, n_rows,
  concat_ws(',', {', '.join(f"CASE WHEN d_{c} THEN '{c}' END" for c in _OTHER)}) AS differing_columns,
  NOT ({' OR '.join(f'd_{c}' for c in _OTHER if c != 'enrolled')}) AS features_identical,
  NOT d_enrolled AS labels_identical, label_values FROM g
""".replace("\n, g AS", "\nSELECT * FROM (WITH g AS", 1).rstrip() + ")")
oracle("duplicates_by_region", """
SELECT region, CAST(count(*) AS BIGINT) AS dup_rows, CAST(count(*) // 2 AS BIGINT) AS dup_pairs FROM emp
WHERE employee_id IN (SELECT employee_id FROM emp GROUP BY employee_id HAVING count(*) > 1) GROUP BY region
""")
oracle("split_balance", """
SELECT split, n, rate, max(rate) OVER () - min(rate) OVER () AS rate_gap,
  max(rate) OVER () - min(rate) OVER () < 0.001e0 AS balanced
FROM (SELECT split, CAST(count(*) AS BIGINT) AS n, avg(CAST(enrolled AS DOUBLE)) AS rate FROM splits GROUP BY split) x
""", floats=["rate", "rate_gap"])

# --------------------------------------------------------------------------- duplicates / windows / top-K
oracle("dedup_keep_none", "SELECT * FROM dedup", floats=EMP_FLOATS)
oracle("dedup_keep_first", """
SELECT * FROM emp QUALIFY row_number() OVER (PARTITION BY employee_id
  ORDER BY legacy_propensity_score IS NULL, enrolled) = 1
""", floats=EMP_FLOATS)
oracle("mark_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicate
FROM lineitem
""", ints=["l_orderkey", "l_linenumber", "l_partkey", "dup_count"])
oracle("sort_scores", "SELECT employee_id, p FROM scored", floats=["p"])
oracle("rank_topk", """
SELECT row_number() OVER (ORDER BY p DESC, employee_id) AS rank, employee_id, p FROM scored
ORDER BY p DESC, employee_id LIMIT 10
""", ints=["rank"], floats=["p"])
oracle("rank_filtered", """
SELECT s.region, s.rank, s.employee_id, s.employment_type, s.p FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY p ASC, employee_id) AS rank FROM scored
  WHERE lower(region) = 'west' AND lower(employment_type) = 'full-time') s
JOIN reg r ON s.region = r.region WHERE s.rank <= least(r.hr_outreach_capacity, 10)
""", ints=["rank"], floats=["p"])
oracle("rank_summary", """
SELECT c.region, c.total_eligible, r.hr_outreach_capacity AS hr_capacity_cap_applied,
  least(c.total_eligible, r.hr_outreach_capacity) AS returned_count
FROM (SELECT region, CAST(count(*) AS BIGINT) AS total_eligible FROM scored GROUP BY region) c
LEFT JOIN reg r ON c.region = r.region
""", ints=["returned_count"])
_REG_ATTRS = ["n_employees_region", "hist_enrollment_rate_region", "avg_salary_region", "avg_premium_cost_usd",
              "benefits_broker_rating", "hr_outreach_capacity", "open_enrollment_window_days",
              "state_mandate_level"]
oracle("region_profile", "\nUNION ALL\n".join(
    f"SELECT region, '{a}' AS attribute, CAST({a} AS VARCHAR) AS value FROM region_profile" for a in _REG_ATTRS))
oracle("split_overlap", """
, sig AS (SELECT concat_ws('_', CAST(e.salary AS VARCHAR), CAST(e.age AS VARCHAR), e.region) AS signature, s.split
  FROM eng e JOIN splits s ON e.employee_id = s.employee_id)
SELECT signature FROM sig WHERE split = 'train' INTERSECT SELECT signature FROM sig WHERE split = 'test'
""".replace("\n, sig AS", "\nSELECT * FROM (WITH sig AS", 1).rstrip() + ")")

# --------------------------------------------------------------------------- scalar functions
oracle("parse_dates", """
SELECT employee_id, application_date, app_date, last_contact_date, contact_date FROM eng
""", dates=["app_date", "contact_date"])
oracle("days_contact_to_app", "SELECT employee_id, days_contact_to_app FROM eng")
oracle("contact_after_app", "SELECT employee_id, contact_after_app FROM eng")
oracle("has_application_date", "SELECT employee_id, has_application_date FROM eng")
oracle("sentinel_flags", """
SELECT employee_id, prior_year_enrolled, no_prior_record, prior_year_enrolled_clean FROM eng
""")
oracle("canon_channel", "SELECT employee_id, last_contact_channel, last_contact_channel_clean FROM eng")
oracle("canon_tier", "SELECT employee_id, plan_tier_requested, plan_tier_requested_clean FROM eng")
oracle("canon_mandate", f"""
SELECT region, state_mandate_level, {case_map('state_mandate_level', MANDATE)} AS state_mandate_level_clean FROM reg
""")
_CH_KEYS = ", ".join(f"'{k}'" for k in CHANNEL)
_TI_KEYS = ", ".join(f"'{k}'" for k in TIER)
_MA_KEYS = ", ".join(f"'{k}'" for k in MANDATE)
oracle("unmapped_labels", f"""
SELECT DISTINCT 'last_contact_channel' AS column_name, last_contact_channel AS raw_value FROM dedup
WHERE last_contact_channel IS NOT NULL AND last_contact_channel NOT IN ({_CH_KEYS})
UNION ALL
SELECT DISTINCT 'plan_tier_requested', plan_tier_requested FROM dedup
WHERE plan_tier_requested IS NOT NULL AND plan_tier_requested NOT IN ({_TI_KEYS})
UNION ALL
SELECT DISTINCT 'state_mandate_level', state_mandate_level FROM reg
WHERE state_mandate_level IS NOT NULL AND state_mandate_level NOT IN ({_MA_KEYS})
""")
oracle("canon_report", """
SELECT 'last_contact_channel' AS column_name, last_contact_channel AS raw_value,
  last_contact_channel_clean AS clean_value, CAST(count(*) AS BIGINT) AS count FROM eng GROUP BY ALL
UNION ALL
SELECT 'plan_tier_requested', plan_tier_requested, plan_tier_requested_clean, CAST(count(*) AS BIGINT)
FROM eng GROUP BY ALL
""")
_XT = "coalesce(plan_tier_requested, 'Unknown')"
_XC = "coalesce(last_contact_channel, 'Unknown')"
oracle("canon_trim", f"""
SELECT employee_id,
  coalesce({case_map(_XT, TIER)}, {case_map(f'trim({_XT})', TIER)}, 'Unknown') AS plan_tier_requested_clean,
  coalesce({case_map(_XC, CHANNEL)}, {case_map(f'trim({_XC})', CHANNEL)}, 'Unknown') AS last_contact_channel_clean
FROM dedup
""")
oracle("fill_unknown", "SELECT employee_id, broker_channel, broker_channel_clean FROM eng")
oracle("median_impute", """
SELECT e.employee_id, s.split, coalesce(CAST(e.days_contact_to_app AS DOUBLE),
  (SELECT quantile_cont(CAST(e2.days_contact_to_app AS DOUBLE), 0.5) FROM eng e2
   JOIN splits s2 ON e2.employee_id = s2.employee_id WHERE s2.split = 'train')) AS days_contact_to_app_imputed
FROM eng e JOIN splits s ON e.employee_id = s.employee_id
""", floats=["days_contact_to_app_imputed"])
oracle("dependents_flag", "SELECT employee_id, has_dependents, has_dependents_bin FROM eng")
oracle("tenure_flag", "SELECT employee_id, age, tenure_years, tenure_inconsistent FROM eng", floats=["tenure_years"])
oracle("categorical_domain", """
SELECT employee_id,
  CASE WHEN employment_type IN ('Contract', 'Full-time', 'Part-time') THEN employment_type END AS employment_type,
  CASE WHEN region IN ('Midwest', 'Northeast', 'South', 'West') THEN region END AS region,
  CASE WHEN state_mandate_level IN ('High', 'Low', 'Medium') THEN state_mandate_level END AS state_mandate_level,
  CASE WHEN last_contact_channel_clean IN ('Email', 'Phone', 'SMS', 'Unknown') THEN last_contact_channel_clean END
    AS last_contact_channel_clean,
  CASE WHEN plan_tier_requested_clean IN ('Basic', 'Bronze', 'Gold', 'Premium', 'Silver', 'Standard', 'Unknown')
    THEN plan_tier_requested_clean END AS plan_tier_requested_clean,
  CASE WHEN broker_channel_clean IN ('Direct', 'Employer-Sponsored', 'Third-Party', 'Unknown')
    THEN broker_channel_clean END AS broker_channel_clean
FROM eng
""")
oracle("category_codes", """
SELECT d.employee_id, d.employment_type, coalesce(l.code, -1) AS employment_type_code
FROM dedup d LEFT JOIN (SELECT employment_type, row_number() OVER (ORDER BY employment_type) - 1 AS code
  FROM (SELECT DISTINCT employment_type FROM dedup WHERE employment_type IS NOT NULL) x) l
  ON d.employment_type = l.employment_type
""", ints=["employment_type_code"])
oracle("age_bands", """
SELECT employee_id, age, CASE WHEN age > 20 AND age <= 35 THEN '20-35' WHEN age > 35 AND age <= 50 THEN '36-50'
  WHEN age > 50 AND age <= 65 THEN '51-65' END AS age_group FROM dedup
""")
oracle("text_case", """
SELECT employee_id, plan_tier_requested, lower(plan_tier_requested) AS lower_value,
  trim(plan_tier_requested) AS stripped_value,
  array_to_string(list_transform(string_split(lower(trim(plan_tier_requested)), ' '),
    lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS title_value
FROM dedup
""")
MED_RE2 = (r"(^|[^\pL\pN_])(diagnose|diagnosis|treatment|medical advice|doctor|prescription|illness|disease|"
           r"condition|therapy|symptom|cure|medication|diabetes|cancer)($|[^\pL\pN_])")
DISC_RE2 = (r"filter out (female|male|women|men|other gender)|exclude (female|male|women|men|other gender)|"
            r"deny (female|male|women|men|other gender)|only hire (female|male|women|men)|discriminate")
PROMPTS = """(SELECT conv_id, turn, text || CASE (conv_id + turn) % 11
    WHEN 0 THEN ' Which plan is best to treat my diabetes?'
    WHEN 1 THEN ' Please filter out female employees from the list.'
    WHEN 2 THEN ' I need a Doctor.' WHEN 3 THEN ' We must never discriminate.'
    WHEN 4 THEN ' exclude men from outreach' WHEN 5 THEN ' the air conditioning is curative'
    ELSE '' END AS text FROM conversations)"""
oracle("screen_prompts", f"""
SELECT conv_id, turn, refusal_type IS NULL AS allowed, refusal_type FROM (
  SELECT conv_id, turn, CASE WHEN text IS NULL OR trim(text) = '' THEN NULL
    WHEN regexp_matches(lower(text), '{MED_RE2}') THEN 'MEDICAL_ADVICE_REFUSAL'
    WHEN regexp_matches(lower(text), '{DISC_RE2}') THEN 'DISCRIMINATION_GUARDRAIL_REFUSAL' END AS refusal_type
  FROM {PROMPTS} p) x
""")


def cte(name_body_pairs, select: str) -> str:
    """Extra CTEs after the shared ones: wrapped as a sub-WITH for DuckDB."""
    ctes = ",\n".join(f"{n} AS ({b})" for n, b in name_body_pairs)
    return f"SELECT * FROM (WITH {ctes}\n{select}) z"


# --------------------------------------------------------------------------- composite jobs
ENG_FLOATS = ["salary", "tenure_years", "legacy_propensity_score", "hist_enrollment_rate_region",
              "avg_salary_region", "benefits_broker_rating"]
oracle("engineer_features", "SELECT * FROM eng", floats=ENG_FLOATS, dates=["app_date", "contact_date"])
_REC = """SELECT * REPLACE (CASE WHEN employee_id % 50 = 0 THEN NULL WHEN employee_id % 50 = 1 THEN lower(region)
    ELSE region END AS region) FROM emp"""
_DOM = """employee_id, reason, salary,
  CASE WHEN employment_type IN ('Contract', 'Full-time', 'Part-time') THEN employment_type END AS employment_type,
  CASE WHEN region IN ('Midwest', 'Northeast', 'South', 'West') THEN region END AS region,
  tenure_years, hist_enrollment_rate_region, avg_premium_cost_usd, benefits_broker_rating, hr_outreach_capacity,
  open_enrollment_window_days,
  CASE WHEN state_mandate_level IN ('High', 'Low', 'Medium') THEN state_mandate_level END AS state_mandate_level,
  has_application_date, days_contact_to_app, contact_after_app, no_prior_record, prior_year_enrolled_clean,
  CASE WHEN last_contact_channel_clean IN ('Email', 'Phone', 'SMS', 'Unknown') THEN last_contact_channel_clean END
    AS last_contact_channel_clean,
  CASE WHEN plan_tier_requested_clean IN ('Basic', 'Bronze', 'Gold', 'Premium', 'Silver', 'Standard', 'Unknown')
    THEN plan_tier_requested_clean END AS plan_tier_requested_clean,
  CASE WHEN broker_channel_clean IN ('Direct', 'Employer-Sponsored', 'Third-Party', 'Unknown')
    THEN broker_channel_clean END AS broker_channel_clean,
  has_dependents_bin, tenure_inconsistent"""
oracle("preprocess_scoring", cte([
    ("rec", _REC),
    ("recv", """SELECT *, CASE WHEN region IS NULL THEN 'missing_region'
        WHEN NOT EXISTS (SELECT 1 FROM reg r WHERE r.region = rec.region) THEN 'unknown_region' END AS reason
        FROM rec"""),
    ("er", eng_sql("recv"))], f"SELECT {_DOM} FROM er"),
    floats=["salary", "tenure_years", "hist_enrollment_rate_region", "benefits_broker_rating"])
_QD = [("application_date", "application_date", "CAST(app_date AS VARCHAR)"),
       ("last_contact_date", "last_contact_date", "CAST(contact_date AS VARCHAR)"),
       ("last_contact_channel", "last_contact_channel", "last_contact_channel_clean"),
       ("plan_tier_requested", "plan_tier_requested", "plan_tier_requested_clean"),
       ("broker_channel", "broker_channel", "broker_channel_clean"),
       ("prior_year_enrolled", "prior_year_enrolled",
        "CASE WHEN no_prior_record = 1 THEN 'no_record' ELSE CAST(prior_year_enrolled_clean AS VARCHAR) END"),
       ("has_dependents", "has_dependents", "CAST(has_dependents_bin AS VARCHAR)")]
oracle("quality_diagnostic", "\nUNION ALL\n".join(
    f"SELECT employee_id, '{f}' AS field, CAST({r} AS VARCHAR) AS raw_value, {c} AS clean_value, "
    f"NOT (CAST({r} AS VARCHAR) IS NOT DISTINCT FROM {c}) AS changed FROM eng" for f, r, c in _QD))
oracle("sentinel_variant", """
SELECT employee_id, CAST(age AS DOUBLE) AS age, salary, tenure_years,
  coalesce(CAST(days_contact_to_app AS DOUBLE), -999e0) AS days_contact_to_app, has_application_date, enrolled
FROM eng
""", floats=["age", "salary", "tenure_years", "days_contact_to_app"])
oracle("stratified_split", "SELECT employee_id, enrolled, class_rank, split, fold FROM splits")
oracle("stratified_folds", "SELECT employee_id, enrolled, class_rank, fold FROM splits")
oracle("split_sample", """
SELECT split, employee_id, rn FROM (
  SELECT split, employee_id, row_number() OVER (PARTITION BY split ORDER BY employee_id) AS rn FROM splits) x
WHERE rn <= 10
""", ints=["rn"])
oracle("oof_region_rate", """
SELECT p.region, p.fold,
  CASE WHEN t.n - p.fn <> 0 THEN CAST(t.s - p.fs AS DOUBLE) / CAST(t.n - p.fn AS DOUBLE) END AS oof_rate
FROM (SELECT e.region, s.fold, sum(e.enrolled) AS fs, count(*) AS fn FROM eng e
      JOIN splits s ON e.employee_id = s.employee_id GROUP BY e.region, s.fold) p
JOIN (SELECT region, sum(enrolled) AS s, count(*) AS n FROM eng GROUP BY region) t ON p.region = t.region
""", ints=["fold"], floats=["oof_rate"])

# --------------------------------------------------------------------------- metrics
_HIST = """SELECT p, CAST(sum(enrolled) AS BIGINT) AS pos, CAST(sum(1 - enrolled) AS BIGINT) AS neg
  FROM scored GROUP BY p"""
_CUM = """SELECT *, coalesce(sum(pos) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pb,
    coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
    sum(pos) OVER () AS tp_all, sum(neg) OVER () AS tn_all FROM h"""
oracle("metric_auc", cte([("h", _HIST), ("c", _CUM)], """
SELECT CAST(sum(pos * (2 * nb + neg)) AS DOUBLE) / CAST(sum(pos) * sum(neg) * 2 AS DOUBLE) AS roc_auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c"""), floats=["roc_auc"])
oracle("metric_avg_precision", cte([("h", _HIST), ("c", _CUM)], """
SELECT sum(CAST(pos AS DOUBLE) / CAST(tp_all AS DOUBLE) * CAST(tp_all - pb AS DOUBLE)
  / CAST((tp_all - pb) + (tn_all - nb) AS DOUBLE)) AS average_precision FROM c"""), floats=["average_precision"])
_CNT = """SELECT count(*) FILTER (WHERE p >= 0.5e0 AND enrolled = 1) AS tp,
  count(*) FILTER (WHERE p >= 0.5e0 AND enrolled = 0) AS fp,
  count(*) FILTER (WHERE p < 0.5e0 AND enrolled = 1) AS fn,
  count(*) FILTER (WHERE p < 0.5e0 AND enrolled = 0) AS tn FROM scored"""
oracle("metric_threshold", cte([("k", _CNT)], """
SELECT tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM k"""),
       ints=["tp", "fp", "fn", "tn"], floats=["accuracy", "precision", "recall", "f1"])
oracle("metric_brier", "SELECT avg(pow(p - enrolled, 2)) AS brier FROM scored", floats=["brier"])
oracle("metric_logloss", """
SELECT avg(-(enrolled * ln(least(greatest(p, 1e-15), 1 - 1e-15))
  + (1 - enrolled) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))) AS log_loss FROM scored
""", floats=["log_loss"])
oracle("confusion_matrix", """
SELECT enrolled AS actual, CAST(count(*) FILTER (WHERE p < 0.5e0) AS BIGINT) AS pred_0,
  CAST(count(*) FILTER (WHERE p >= 0.5e0) AS BIGINT) AS pred_1 FROM scored GROUP BY enrolled
""")
oracle("classification_report", cte([("k", _CNT), ("r", """
  SELECT '0' AS label, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS precision,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS recall,
    CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0 END AS f1, tn + fp AS support FROM k
  UNION ALL
  SELECT '1', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, tp + fn FROM k""")], """
SELECT label, precision, recall, f1, support FROM r
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM r"""), ints=["support"],
       floats=["precision", "recall", "f1"])
oracle("naive_baselines", cte([("k", """SELECT
    count(*) FILTER (WHERE has_dependents_bin = 1 AND enrolled = 1) AS tp,
    count(*) FILTER (WHERE has_dependents_bin = 1 AND enrolled = 0) AS fp,
    count(*) FILTER (WHERE has_dependents_bin = 0 AND enrolled = 1) AS fn,
    count(*) FILTER (WHERE has_dependents_bin = 0 AND enrolled = 0) AS tn FROM eng""")], """
SELECT greatest((tp + fn) / (tp + fp + fn + tn), 1 - (tp + fn) / (tp + fp + fn + tn)) AS majority_accuracy,
  (tp + tn) / (tp + fp + fn + tn) AS rule_accuracy,
  (tp * tn + (tp * fp + fn * tn) / 2) / ((tp + fn) * (fp + tn)) AS rule_auc FROM k"""),
       floats=["majority_accuracy", "rule_accuracy", "rule_auc"])
oracle("precision_lift_at_k", cte([
    ("t", "SELECT s.* FROM scored s JOIN splits sp ON s.employee_id = sp.employee_id WHERE sp.split = 'test'"),
    ("top", """SELECT t.* FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p DESC, employee_id) AS rn
        FROM t) t JOIN reg r ON t.region = r.region WHERE t.rn <= CAST(round(r.hr_outreach_capacity / 5e0) AS BIGINT)""")],
    """
SELECT b.region, b.n, b.base_rate, p.k, p.precision_at_k,
  CASE WHEN b.base_rate <> 0 THEN p.precision_at_k / b.base_rate END AS lift_at_k
FROM (SELECT region, CAST(count(*) AS BIGINT) AS n, avg(CAST(enrolled AS DOUBLE)) AS base_rate FROM t GROUP BY region) b
LEFT JOIN (SELECT region, CAST(count(*) AS BIGINT) AS k, avg(CAST(enrolled AS DOUBLE)) AS precision_at_k
           FROM top GROUP BY region) p ON b.region = p.region"""),
       floats=["base_rate", "precision_at_k", "lift_at_k"])
oracle("calibration_bins", """
SELECT CAST(least(floor(p * 10), 9) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, avg(p) AS mean_p,
  avg(CAST(enrolled AS DOUBLE)) AS observed_rate FROM scored GROUP BY 1
""", floats=["mean_p", "observed_rate"])

# --------------------------------------------------------------------------- governance
_LEAK = ["legacy_propensity_score", "salary", "age", "tenure_years", "hist_enrollment_rate_region",
         "days_contact_to_app"]


def _leakage(columns):
    rows = "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v, enrolled AS y FROM eng "
                                f"WHERE {c} IS NOT NULL" for c in columns)
    return cte([
        ("lk", rows),
        ("h", "SELECT column_name, v, sum(y) AS pos, sum(1 - y) AS neg FROM lk GROUP BY column_name, v"),
        ("hc", """SELECT *, coalesce(sum(neg) OVER (PARTITION BY column_name ORDER BY v
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM h"""),
        ("a", """SELECT column_name, CAST(sum(pos * (2 * nb + neg)) AS DOUBLE) / CAST(sum(pos) * sum(neg) * 2 AS DOUBLE)
            AS solo_auc FROM hc GROUP BY column_name"""),
        ("st", """SELECT column_name, avg(CASE WHEN y = 0 THEN v END) AS mean_neg, avg(CASE WHEN y = 1 THEN v END) AS mean_pos,
            corr(v, CAST(y AS DOUBLE)) AS corr,
            avg(CASE WHEN CAST(v >= 0.5e0 AS INT) = y THEN 1e0 ELSE 0e0 END) AS threshold_accuracy,
            CAST(count(*) AS BIGINT) AS n FROM lk GROUP BY column_name""")], """
SELECT st.column_name, mean_neg, mean_pos, corr, threshold_accuracy, n, a.solo_auc, mean_pos - mean_neg AS gap,
  CASE WHEN corr > 0.9e0 THEN 'LEAKY' ELSE 'REVIEW' END AS verdict
FROM st LEFT JOIN a ON st.column_name = a.column_name""")


_LEAK_FLOATS = ["mean_neg", "mean_pos", "corr", "threshold_accuracy", "solo_auc", "gap"]
oracle("leakage_screen", _leakage(_LEAK), floats=_LEAK_FLOATS)
oracle("leakage_screen_all", _leakage([
    "age", "salary", "tenure_years", "prior_year_enrolled", "legacy_propensity_score", "n_employees_region",
    "hist_enrollment_rate_region", "avg_salary_region", "avg_premium_cost_usd", "benefits_broker_rating",
    "hr_outreach_capacity", "open_enrollment_window_days", "has_application_date", "days_contact_to_app",
    "contact_after_app", "no_prior_record", "prior_year_enrolled_clean", "has_dependents_bin", "tenure_inconsistent"]),
       floats=_LEAK_FLOATS)
oracle("leakage_aggregate", cte([
    ("t", """SELECT coalesce(e.hist_enrollment_rate_region, 0e0) AS p, e.enrolled FROM eng e
        JOIN splits s ON e.employee_id = s.employee_id WHERE s.split = 'test'"""),
    ("h", "SELECT p, sum(enrolled) AS pos, sum(1 - enrolled) AS neg FROM t GROUP BY p"),
    ("c", """SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM h"""),
    ("au", """SELECT CAST(sum(pos * (2 * nb + neg)) AS DOUBLE) / CAST(sum(pos) * sum(neg) * 2 AS DOUBLE) AS test_auc
        FROM c"""),
    ("ov", """SELECT corr(hist_enrollment_rate_region, CAST(enrolled AS DOUBLE)) AS corr,
        avg(CAST(enrolled AS DOUBLE)) AS overall_rate FROM eng""")], """
SELECT g.region, g.actual_rate, g.published_rate, abs(g.actual_rate - g.published_rate) AS diff,
  ov.corr, ov.overall_rate, au.test_auc
FROM (SELECT region, avg(CAST(enrolled AS DOUBLE)) AS actual_rate, min(hist_enrollment_rate_region) AS published_rate
      FROM eng GROUP BY region) g, ov, au"""),
       floats=["actual_rate", "published_rate", "diff", "corr", "overall_rate", "test_auc"])
oracle("refuse_leakage", """
SELECT request_id, employee_id, feature_requested,
  CASE WHEN coalesce(contains(lower(feature_requested), 'legacy_propensity_score'), false) THEN 'refusal'
    ELSE 'ok' END AS status,
  CASE WHEN coalesce(contains(lower(feature_requested), 'legacy_propensity_score'), false)
    THEN 'TARGET_LEAKAGE_REFUSAL' END AS refusal_type
FROM (SELECT o_orderkey AS request_id, o_custkey AS employee_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'legacy_propensity_score' WHEN 1 THEN 'LEGACY_PROPENSITY_SCORE_v2'
    WHEN 2 THEN 'salary' WHEN 3 THEN NULL ELSE 'days_contact_to_app' END AS feature_requested FROM orders) r
""", ints=["request_id", "employee_id"])
_DRV = """SELECT employee_id,
    CASE WHEN coalesce(trim(has_dependents) = 'Yes', false) THEN 'Positive' ELSE 'Negative' END AS dep_effect,
    CASE WHEN coalesce(salary, 60000e0) >= 60000e0 THEN 'Positive' ELSE 'Negative' END AS sal_effect,
    CASE WHEN employment_type = 'Full-time' THEN 'Positive'
         WHEN employment_type IN ('Part-time', 'Contract') THEN 'Negative' END AS emp_effect,
    CASE WHEN prior_year_enrolled = 1 THEN 'Positive' WHEN prior_year_enrolled = 0 THEN 'Negative' END AS prior_effect,
    CASE WHEN lower(trim(plan_tier_requested)) IN ('gold', 'premium', 'silver') THEN 'Positive' END AS tier_effect
  FROM dedup"""
oracle("explain_drivers", cte([("dv", _DRV)], """
SELECT employee_id, 0 AS driver_pos, 'has_dependents' AS feature, dep_effect AS effect FROM dv
UNION ALL SELECT employee_id, 1, 'salary', sal_effect FROM dv
UNION ALL SELECT employee_id, 2, 'employment_type', emp_effect FROM dv WHERE emp_effect IS NOT NULL
UNION ALL SELECT employee_id, 2 + CAST(emp_effect IS NOT NULL AS INT), 'prior_year_enrolled', prior_effect FROM dv
  WHERE prior_effect IS NOT NULL
UNION ALL SELECT employee_id, 2 + CAST(emp_effect IS NOT NULL AS INT) + CAST(prior_effect IS NOT NULL AS INT),
  'plan_tier_requested', tier_effect FROM dv WHERE tier_effect IS NOT NULL"""), ints=["driver_pos"])
oracle("explain_protected", cte([("dv", _DRV)], """
SELECT employee_id, 2 + CAST(emp_effect IS NOT NULL AS INT) + CAST(prior_effect IS NOT NULL AS INT)
  + CAST(tier_effect IS NOT NULL AS INT) AS n_drivers, false AS has_protected FROM dv"""), ints=["n_drivers"])
_AUD = cte([("au", """SELECT s.employee_id, s.p, s.enrolled, d.gender, d.age, d.marital_status,
      CASE WHEN d.age > 20 AND d.age <= 35 THEN '20-35' WHEN d.age > 35 AND d.age <= 50 THEN '36-50'
        WHEN d.age > 50 AND d.age <= 65 THEN '51-65' END AS age_group
    FROM splits sp JOIN scored s ON sp.employee_id = s.employee_id JOIN dedup d ON d.employee_id = s.employee_id
    WHERE sp.split = 'test'"""),
    ("lv", """SELECT 'gender' AS dimension, gender AS level, enrolled, p FROM au
      UNION ALL SELECT 'age_group', age_group, enrolled, p FROM au
      UNION ALL SELECT 'marital_status', marital_status, enrolled, p FROM au""")], """
SELECT dimension, level, CAST(count(*) AS BIGINT) AS count, avg(CAST(enrolled AS DOUBLE)) AS actual_rate,
  avg(CASE WHEN p >= 0.5e0 THEN 1e0 ELSE 0e0 END) AS pred_rate, avg(p) AS avg_prob
FROM lv WHERE level IS NOT NULL GROUP BY dimension, level""")
oracle("fairness_audit", _AUD.replace(HEAD, ""), floats=["actual_rate", "pred_rate", "avg_prob"])
oracle("fairness_gap", f"SELECT dimension, level, actual_rate, pred_rate, pred_rate - actual_rate AS gap FROM ({_AUD}) g",
       floats=["actual_rate", "pred_rate", "gap"])

oracle("filter_ci_status", """
SELECT w.requested, CAST(count(d.employee_id) AS BIGINT) AS n_matches,
  CASE WHEN count(d.employee_id) > 0 THEN 'ok' ELSE 'no_match' END AS status
FROM (VALUES ('WEST'), ('south'), ('Atlantis')) w(requested) LEFT JOIN dedup d ON lower(d.region) = lower(w.requested)
GROUP BY w.requested""")
oracle("canon_no_nulls", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, count(*) = count({c}) AS no_nulls FROM eng"
    for c in ("last_contact_channel_clean", "plan_tier_requested_clean", "broker_channel_clean")))

# --------------------------------------------------------------------------- deterministic parts of model-backed jobs
_TEST = "SELECT s.employee_id, s.enrolled FROM splits s WHERE s.split = 'test'"
for _key in ("score_reproducible", "model_roundtrip"):
    oracle(_key, f"SELECT CAST(count(*) AS BIGINT) AS n, 0e0 AS max_abs_diff, 1 AS classes_equal FROM ({_TEST}) t",
           ints=["classes_equal"], floats=["max_abs_diff"])
_ARRIVING = """SELECT *, CASE WHEN region IS NULL THEN 'missing_region'
    WHEN NOT EXISTS (SELECT 1 FROM reg r WHERE r.region = x.region) THEN 'unknown_region' END AS reason
  FROM (SELECT employee_id, CASE WHEN employee_id % 50 = 0 THEN NULL WHEN employee_id % 50 = 1 THEN lower(region)
        ELSE region END AS region FROM emp) x"""
oracle("score_batch_ids", f"SELECT employee_id, reason FROM ({_ARRIVING}) a")
oracle("score_records_status", f"""
SELECT employee_id, CASE WHEN reason IS NULL THEN 'success' ELSE 'error' END AS status, reason AS error
FROM ({_ARRIVING}) a""")
oracle("score_requests_status", """
SELECT q.request_id, q.employee_id,
  CASE WHEN q.k IN (0, 1) THEN 'refusal' WHEN d.employee_id IS NULL THEN 'not_found'
       WHEN r.region IS NULL THEN 'error' ELSE 'success' END AS status
FROM (SELECT CAST(o_orderkey AS BIGINT) AS request_id, CAST(o_custkey AS BIGINT) AS employee_id, o_orderkey % 5 AS k FROM orders) q
LEFT JOIN dedup d ON d.employee_id = q.employee_id LEFT JOIN reg r ON r.region = d.region""")
oracle("explain_narrative_fields", """
SELECT employee_id, round(p, 4) AS enrollment_probability, CAST(p >= 0.5e0 AS BIGINT) AS predicted_enrolled FROM scored""",
       floats=["enrollment_probability"])
oracle("io_json_parsed", """
SELECT s.rank, s.employee_id, s.region, round(s.p, 4) AS enrollment_probability,
  CAST(s.p >= 0.5e0 AS BIGINT) AS predicted_enrolled
FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p DESC, employee_id) AS rank FROM scored) s
LEFT JOIN reg r ON s.region = r.region WHERE s.rank <= least(r.hr_outreach_capacity, 10)""",
       ints=["rank"], floats=["enrollment_probability"])
oracle("rank_model_summary", f"""
SELECT c.region, c.n AS total_eligible, r.hr_outreach_capacity AS hr_capacity_cap_applied,
  least(c.n, r.hr_outreach_capacity) AS returned_count
FROM (SELECT region, CAST(count(*) AS BIGINT) AS n FROM ({_ARRIVING}) a
      WHERE reason IS NULL AND employee_id IN (SELECT employee_id FROM dedup) GROUP BY region) c
LEFT JOIN reg r ON c.region = r.region""", ints=["returned_count"])
oracle("fairness_model_base", f"SELECT dimension, level, count, actual_rate FROM ({_AUD}) g", floats=["actual_rate"])

oracle("explain_model_status", f"""
SELECT employee_id, CASE WHEN reason IS NULL THEN 'success' ELSE 'error' END AS status, reason AS error,
  CASE WHEN reason IS NULL THEN true END AS agrees
FROM ({_ARRIVING}) a WHERE employee_id IN (SELECT employee_id FROM dedup)""")
oracle("precision_lift_model_counts", """
SELECT b.region, b.n, b.base_rate, least(b.n, CAST(round(r.hr_outreach_capacity / 5e0) AS BIGINT)) AS k
FROM (SELECT s.region, CAST(count(*) AS BIGINT) AS n, avg(CAST(s.enrolled AS DOUBLE)) AS base_rate
      FROM scored s JOIN splits sp ON s.employee_id = sp.employee_id WHERE sp.split = 'test' GROUP BY s.region) b
LEFT JOIN reg r ON b.region = r.region""", ints=["k"], floats=["base_rate"])

# --------------------------------------------------------------------------- streaming
ORACLE["stream_preprocess_scoring"] = ORACLE["preprocess_scoring"]

# --------------------------------------------------------------------------- sinks / encoders
oracle("io_write_splits", "SELECT split, CAST(count(*) AS BIGINT) AS n FROM splits GROUP BY split")
_ENC_NUM = ["age", "salary", "tenure_years", "prior_year_enrolled", "legacy_propensity_score"]
oracle("label_encode_all", "SELECT employee_id, enrolled, "
       + ", ".join(f"coalesce(CAST({c} AS DOUBLE), -999e0) AS {c}" for c in _ENC_NUM) + ", "
       + ", ".join(f"dense_rank() OVER (ORDER BY coalesce({c}, 'nan')) - 1 AS {c}_code" for c in _EMP_TEXT)
       + " FROM emp", ints=[f"{c}_code" for c in _EMP_TEXT], floats=_ENC_NUM)
