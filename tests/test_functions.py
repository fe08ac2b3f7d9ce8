"""Scalar rules G1, G3, G4, G7, G11, G20 on hand-made frames."""
import datetime as dt

from pyspark.sql import functions as F

from benefitlens.functions import canon, dates, flags
from benefitlens.constants import CHANNEL_MAP, TIER_MAP

D = dt.date

# (text, day-first result, month-first result)
DATE_CASES = [
    ("2024-01-02", D(2024, 1, 2), D(2024, 1, 2)),
    ("02/01/2024", D(2024, 1, 2), D(2024, 2, 1)),
    ("13/07/2024", D(2024, 7, 13), D(2024, 7, 13)),
    ("07/13/2024", D(2024, 7, 13), D(2024, 7, 13)),
    ("31/02/2024", None, None),
    ("", None, None),
    (None, None, None),
    (" 2024-01-02", D(2024, 1, 2), D(2024, 1, 2)),
    ("2024-1-2", D(2024, 1, 2), D(2024, 1, 2)),
    ("2024/01/02", D(2024, 1, 2), D(2024, 1, 2)),
    ("Jan 5 2024", D(2024, 1, 5), D(2024, 1, 5)),
    ("2024-13-01", None, None),
    ("2024-01-02 10:00:00", D(2024, 1, 2), D(2024, 1, 2)),
    ("2024-01-02T06:00:00", D(2024, 1, 2), D(2024, 1, 2)),
    ("13/07/24", D(2024, 7, 13), D(2024, 7, 13)),
    ("02/01/95", D(1995, 1, 2), D(1995, 2, 1)),
    ("13-07-2024", D(2024, 7, 13), D(2024, 7, 13)),
    ("20240102", D(2024, 1, 2), D(2024, 1, 2)),
    ("July 13, 2024", D(2024, 7, 13), D(2024, 7, 13)),
]


def test_mixed_date_parsing(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in DATE_CASES], "t string")
    got = df.select("t", dates.parse_day_first("t").alias("d"), dates.parse_month_first("t").alias("m")).collect()
    by = {r.t: (r.d, r.m) for r in got}
    for t, d, m in DATE_CASES:
        assert by[t] == (d, m), t


def test_a_date_is_tried_only_with_patterns_it_may_match(spark):
    """A slash date failed on three patterns first, each failure an exception."""
    texts = [t for t, _, _ in DATE_CASES if t] + ["-2024/1/2", "+12345-1-2", "5 Jan 2024", "1-2-24", "not a date"]
    df = spark.createDataFrame([(t.strip(),) for t in texts], "t string")
    t = F.col("t")
    rows = df.select("t", *[F.struct(dates._may_match(t, p).alias("may"), F.try_to_date(t, p).isNotNull().alias("is")).alias(p)
                            for p in dates.DAY_FIRST + ["d/M/yy", "M-d-yy"]]).collect()
    assert all(r[p].may for r in rows for p in r.asDict() if p != "t" and r[p]["is"])
    tried = {r.t: [p for p in dates.DAY_FIRST if r[p].may] for r in rows}
    assert tried["13/07/2024"] == ["d/M/yyyy", "M/d/yyyy"] and tried["2024-01-02"][0] == "yyyy-M-d"
    assert not set(tried["20240102"]) - {"yyyyMMdd"}


def test_a_text_without_a_time_takes_no_search_for_one(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02 10:30",), ("2024-01-02 25:30",), (None,)], "t string")
    assert [r[0] for r in df.select(dates.seconds_of_day("t")).collect()] == [0, 37800, None, 0]
    plan = df.select(dates.seconds_of_day("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains(") < plan.index("regexp_extract")


def test_day_gap_and_after_flag_with_missing_sides(spark):
    df = spark.createDataFrame([(D(2024, 1, 10), D(2024, 1, 3)), (None, D(2024, 1, 3)), (D(2024, 1, 1), D(2024, 1, 3))],
                               "a date, c date")
    rows = df.select(dates.days_between(F.col("a"), F.col("c")).alias("d"),
                     dates.after_flag(F.col("c"), F.col("a")).alias("after"),
                     dates.present_flag(F.col("a")).alias("has")).collect()
    assert [(r.d, r.after, r.has) for r in rows] == [(7, 0, 1), (None, 0, 0), (-2, 1, 1)]


def test_flags_treat_missing_as_false(spark):
    df = spark.createDataFrame([("Yes", 30, 15.0, -1), ("yes", None, 1.0, 1), (None, 40, None, None)],
                               "dep string, age int, tenure double, prior int")
    rows = df.select(flags.dependents_flag("dep").alias("d"), flags.tenure_flag("tenure", "age").alias("t"),
                     *[v.alias(k) for k, v in flags.sentinel_flags("prior").items()]).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0)]


def test_nan_becomes_null_before_flags(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,)], "x double")
    rows = df.select(flags.flag(flags.nan_to_null("x") > 1.0).alias("f")).collect()
    assert [r.f for r in rows] == [0, 1]


def test_age_bands_are_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in (20, 21, 35, 36, 50, 51, 65, 66, None)], "age int")
    got = [r.g for r in df.select(flags.age_band("age").alias("g")).collect()]
    assert got == [None, "20-35", "20-35", "36-50", "36-50", "51-65", "51-65", None, None]


def test_dictionaries_are_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([("GOLD",), ("gold",), ("none",), (None,), ("fax",), ("Text",)], "x string")
    rows = df.select(canon.canon_tier("x").alias("t"), canon.canon_channel("x").alias("c")).collect()
    assert [r.t for r in rows] == ["Unknown", "Gold", "Unknown", "Unknown", "Unknown", "Unknown"]
    assert [r.c for r in rows] == ["Unknown", "Unknown", "Unknown", "Unknown", "Unknown", "SMS"]


def test_mandate_unknown_stays_null_and_trim_retry(spark):
    df = spark.createDataFrame([("MED",), ("SEVERE",), (None,), (" silver plan ",)], "x string")
    rows = df.select(canon.canon_mandate("x").alias("m"),
                     canon.lookup_trim_retry("x", TIER_MAP).alias("t")).collect()
    assert [r.m for r in rows] == ["Medium", None, None, None]
    assert [r.t for r in rows] == ["Unknown", "Unknown", "Unknown", "Silver"]
    assert set(CHANNEL_MAP.values()) == {"Email", "Phone", "SMS", "Unknown"}


def test_categorical_domain(spark):
    df = spark.createDataFrame([("Consultant",), ("Contract",), (None,)], "employment_type string")
    got = [r.e for r in df.select(canon.in_domain("employment_type", ["Contract", "Full-time"]).alias("e")).collect()]
    assert got == [None, "Contract", None]


def test_day_gaps_of_timestamps_are_floored(spark):
    from benefitlens.plans.features import add_features
    from benefitlens.schemas import EMP_SCHEMA
    rows = [("2024-01-02", "2024-01-02 06:00:00"), ("2024-01-02 10:00:00", "2024-01-02 06:00:00"),
            ("2024-01-05T06:00:00", "2024-01-02"), ("2024-01-02 25:00:00", "2024-01-01"), (None, "2024-01-01")]
    df = spark.createDataFrame(rows, "application_date string, last_contact_date string")
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in EMP_SCHEMA.fields if f.name not in df.columns})
    got = add_features(df).select("days_contact_to_app", "contact_after_app", "has_application_date").collect()
    assert [tuple(r) for r in got] == [(-1, 1, 1), (0, 0, 1), (3, 0, 1), (None, 0, 0), (None, 0, 0)]
