"""Remaining rules of SURVEY §1.4 (G2, G13, G19) and the scoring suite's
output-format / reproducibility checks."""
import math

import numpy as np
from pyspark.sql import functions as F

from benefitlens.operators import joins, profile


def test_groupby_drops_null_keys_value_counts_keep_them(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), ("a", 1)], "k string, enrolled int")
    assert {r.k: r["count"] for r in profile.value_counts(df, "k").collect()} == {None: 2, "a": 1}
    assert [(r.k, r.rate) for r in profile.rate_by_group(df, "k").collect()] == [("a", 1.0)]


def test_correlation_skips_incomplete_pairs_and_constant_is_null(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (None, 1.0, 5.0), (4.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = df.agg(profile.safe_corr(F.col("a"), F.col("b")).alias("ab"),
                 profile.safe_corr(F.col("a"), F.col("c")).alias("ac")).first()
    pairs = np.array([(a, b) for a, b, _ in rows if a is not None and b is not None])
    assert math.isclose(got.ab, float(np.corrcoef(pairs[:, 0], pairs[:, 1])[0, 1]), rel_tol=1e-12)
    assert got.ac is None


def test_unknown_request_ids_are_reported(spark):
    req = spark.createDataFrame([(1,), (2,), (99,)], "employee_id int")
    known = spark.createDataFrame([(1,), (2,), (3,)], "employee_id int")
    matched, missing = joins.match_requests(req, known)
    assert sorted(r.employee_id for r in matched.collect()) == [1, 2]
    assert [r.employee_id for r in missing.collect()] == [99]


def test_scoring_output_format_and_reproducibility(spark):
    from benefitlens import catalog as C
    from benefitlens.constants import EXPECTED_FEATURES
    from benefitlens.plans import modeling
    from benefitlens.plans.features import preprocess_scoring
    from benefitlens.plans.training import split_frames
    from tests.conftest import SF0001
    e = C._eng(spark, SF0001)
    train, test = split_frames(e)
    model = modeling.tree_pipeline(train, modeling.gbt(max_iter=4)).fit(train)
    feats = preprocess_scoring(C._arriving_records(spark, SF0001), C._reg(spark, SF0001))
    assert feats.columns[2:] == EXPECTED_FEATURES
    a = modeling.score(model, modeling.prepare(feats))
    assert a.columns[-4:] == ["predicted_probability", "predicted_class", "enrollment_probability",
                              "predicted_enrolled"]
    ra = {(r.employee_id, r.reason): r for r in a.collect()}
    rb = {(r.employee_id, r.reason): r for r in modeling.score(model, modeling.prepare(feats)).collect()}
    assert max(abs(ra[k].predicted_probability - rb[k].predicted_probability) for k in ra) < 1e-9
    assert all(r.predicted_class == r.predicted_enrolled == int(r.predicted_probability >= 0.5) for r in ra.values())
    train.unpersist()


def test_request_and_record_scoring_rows(spark):
    from benefitlens import catalog as C
    from benefitlens.plans import modeling
    from benefitlens.plans.outreach import score_records, score_requests
    from benefitlens.plans.training import split_frames
    from tests.conftest import SF0001
    e = C._eng(spark, SF0001)
    train, _ = split_frames(e)
    model = modeling.tree_pipeline(train, modeling.gbt(max_iter=3)).fit(train)
    raw, regs = C._dedup(spark, SF0001), C._reg(spark, SF0001)
    some_id = raw.select("employee_id").first()[0]
    req = spark.createDataFrame([(1, some_id, "salary"), (2, some_id, "Legacy_Propensity_Score"),
                                 (3, 10**9, None)], "request_id long, employee_id long, feature_requested string")
    got = {r.request_id: r for r in score_requests(model, req, raw, regs).collect()}
    assert got[1].status == "success" and 0 <= got[1].enrollment_probability <= 1
    assert got[2].status == "refusal" and got[3].status == "not_found"
    assert "age" not in score_requests(model, req, raw, regs).columns
    rec = C._arriving_records(spark, SF0001)
    out = {r.status: r for r in score_records(model, rec, regs).collect()}
    assert out["error"].enrollment_probability is None and out["error"].error in ("missing_region", "unknown_region")
    assert out["success"].error is None
    train.unpersist()
