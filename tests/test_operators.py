"""Dedup, joins, ranking, split and metric operators against brute force."""
import math
import random

from pyspark.sql import functions as F

from benefitlens.operators import dedup, joins, metrics, ranking, split


def test_dedup_keep_none_drops_every_copy_and_null_keys_compare_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e"), (3, "f")], "id int, v string")
    got = sorted(r.v for r in dedup.dedup_keep_none(df, "id").collect())
    assert got == ["a", "f"]


def test_dedup_keep_first_by_explicit_order(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, None, "z"), (2, 1, "w")], "id int, o int, v string")
    got = {r.id: r.v for r in dedup.dedup_keep_first(df, "id", ["o"]).collect()}
    assert got == {1: "y", 2: "z"}  # nulls first, like an ascending struct order


def test_mark_duplicates_and_conflicts(spark):
    df = spark.createDataFrame([(1, 10.0, 0), (1, 10.0, 1), (2, 5.0, 1), (3, None, 0), (3, 7.0, 0)],
                               "id int, salary double, enrolled int")
    marked = {(r.id, r.dup_count) for r in dedup.mark_duplicates(df, "id").collect()}
    assert marked == {(1, 2), (2, 1), (3, 2)}
    rep = {r.id: r for r in dedup.duplicate_conflicts(df, "id", "enrolled").collect()}
    assert rep[1].differing_columns == "enrolled" and rep[1].features_identical and not rep[1].labels_identical
    assert rep[1].label_values == "0,1"
    assert rep[3].differing_columns == "salary" and not rep[3].features_identical and rep[3].labels_identical


def test_join_cardinality_detects_fanout(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id int, region string")
    good = spark.createDataFrame([("A", 1), ("B", 2)], "region string, x int")
    bad = spark.createDataFrame([("A", 1), ("A", 2)], "region string, x int")
    g = joins.join_cardinality(fact, good).first()
    b = joins.join_cardinality(fact, bad).first()
    assert (g.rows_before, g.rows_after, g.cardinality_ok) == (3, 3, True)
    assert (b.rows_after, b.dim_key_unique, b.cardinality_ok) == (4, False, False)
    um = {(r.side, r.region) for r in joins.unmatched_keys(fact, good).collect()}
    assert um == {("fact_only", "C")}


def _scored(spark, n=300, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["N", "S", "E"]), round(rnd.random(), 2), rnd.randint(0, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "employee_id int, region string, p double, enrolled int"), rows


def test_rank_capacity_caps_per_region_and_breaks_ties_by_id(spark):
    df, rows = _scored(spark)
    regs = spark.createDataFrame([("N", 5), ("S", 12), ("E", 1)], "region string, hr_outreach_capacity int")
    got = ranking.rank_capacity(df, regs, top_k=10).collect()
    for reg, cap in [("N", 5), ("S", 10), ("E", 1)]:
        exp = sorted([r for r in rows if r[1] == reg], key=lambda r: (-r[2], r[0]))[:cap]
        mine = sorted([r for r in got if r.region == reg], key=lambda r: r["rank"])
        assert [r.employee_id for r in mine] == [e[0] for e in exp]


def test_rank_topk_numbers_k_rows(spark):
    df, rows = _scored(spark)
    got = ranking.rank_topk(df, 7).collect()
    exp = sorted(rows, key=lambda r: (-r[2], r[0]))[:7]
    assert [(r["rank"], r.employee_id) for r in got] == [(i + 1, e[0]) for i, e in enumerate(exp)]


def _brute_auc(rows):
    pos = [r[2] for r in rows if r[3] == 1]
    neg = [r[2] for r in rows if r[3] == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _brute_ap(rows):
    P = sum(r[3] for r in rows)
    ap = 0.0
    for t in sorted({r[2] for r in rows}, reverse=True):
        at = [r for r in rows if r[2] >= t]
        tp = sum(r[3] for r in at)
        pos_here = sum(r[3] for r in rows if r[2] == t)
        ap += pos_here / P * tp / len(at)
    return ap


def test_exact_auc_and_average_precision_match_brute_force(spark):
    df, rows = _scored(spark)
    assert math.isclose(metrics.auc(df).first().roc_auc, _brute_auc(rows), rel_tol=1e-12)
    assert math.isclose(metrics.average_precision(df).first().average_precision, _brute_ap(rows), rel_tol=1e-9)


def test_prefix_sums_across_slices_batches_and_groups(spark):
    from benefitlens.operators.prefix import dense_codes, prefix_sums
    df, rows = _scored(spark, n=500, seed=3)
    hist = metrics.score_histogram(df, groups=["region"])
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        c = prefix_sums(hist, "score", ["pos", "neg"], ["region"], slices=9).collect()
        flat = prefix_sums(metrics.score_histogram(df), "score", ["pos", "neg"], slices=11).collect()
        codes = {r.v: r.v_code for r in dense_codes(
            spark.createDataFrame([(x,) for x in "qwertyuiopasdfghjklzxcvbnmq"] + [(None,)], "v string"),
            "v").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for r in c:
        same = [x for x in rows if x[1] == r.region]
        assert r.neg_below == sum(1 for x in same if x[2] < r.score and x[3] == 0)
        assert r.pos_below == sum(1 for x in same if x[2] < r.score and x[3] == 1)
        assert r.pos_total == sum(x[3] for x in same)
    for r in flat:
        assert r.neg_below == sum(1 for x in rows if x[2] < r.score and x[3] == 0)
    assert codes == {ch: i for i, ch in enumerate(sorted(set("qwertyuiopasdfghjklzxcvbnm")))}
    g = metrics.auc(df, groups=["region"]).collect()
    for r in g:
        assert math.isclose(r.roc_auc, _brute_auc([x for x in rows if x[1] == r.region]), rel_tol=1e-12)


def test_threshold_metrics_and_confusion(spark):
    df, rows = _scored(spark)
    m = metrics.threshold_metrics(df).first()
    tp = sum(1 for r in rows if r[2] >= 0.5 and r[3] == 1)
    fp = sum(1 for r in rows if r[2] >= 0.5 and r[3] == 0)
    assert (m.tp, m.fp) == (tp, fp)
    cm = {r.actual: (r.pred_0, r.pred_1) for r in metrics.confusion_matrix(df).collect()}
    assert cm[1][1] == tp and cm[0][1] == fp


def _split_rows(spark, n, pos_share, seed):
    rnd = random.Random(seed)
    return spark.createDataFrame([(i, 1 if rnd.random() < pos_share else 0) for i in range(n)],
                                 "employee_id int, enrolled int")


def test_stratified_split_exact_sizes_and_order(spark):
    import hashlib
    df = _split_rows(spark, 997, 0.62, 1)
    got = split.stratified_split(df).collect()
    n = len(got)
    test = [r for r in got if r.split == "test"]
    assert len(test) == -(-n // 5)
    for cls in (0, 1):
        members = sorted([r for r in got if r.enrolled == cls],
                         key=lambda r: hashlib.md5(f"42:{r.employee_id}".encode()).hexdigest())
        assert [r.class_rank for r in members] == list(range(len(members)))
        k = sum(1 for r in members if r.split == "test")
        assert all(r.split == "test" for r in members[:k])
        assert abs(k - len(members) / 5) <= 1
    assert {r.fold for r in got} == {0, 1, 2, 3, 4}


def test_split_is_independent_of_partitioning(spark):
    df = _split_rows(spark, 500, 0.4, 2)
    a = {(r.employee_id, r.split, r.fold) for r in split.stratified_split(df.repartition(1)).collect()}
    b = {(r.employee_id, r.split, r.fold) for r in split.stratified_split(df.repartition(13)).collect()}
    assert a == b


def test_prefix_sums_two_group_columns_with_null_keys(spark):
    from benefitlens.operators.prefix import prefix_sums
    rows = [(a, b, float(i), 1) for i in range(60) for a, b in [(("x" if i % 2 else None), i % 3)]]
    df = spark.createDataFrame(rows, "a string, b int, o double, w long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = prefix_sums(df, "o", ["w"], ["a", "b"], slices=7).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for r in got:
        same = [x for x in rows if x[0] == r.a and x[1] == r.b]
        assert r.w_below == sum(1 for x in same if x[2] < r.o)
        assert r.w_total == len(same)


def test_exact_quantiles_match_numpy_linear(spark):
    import numpy as np
    from benefitlens.operators.quantiles import exact_quantiles
    rnd = random.Random(11)
    rows = [(g, (float(round(rnd.gauss(50, 20))) if rnd.random() > 0.1 else None)) for g in "abc"
            for _ in range({"a": 7, "b": 40, "c": 1}[g])]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in "abc":
        vals = [v for k, v in rows if k == g and v is not None]
        for p in probs:
            assert math.isclose(got[(g, p)], float(np.percentile(vals, p * 100)), rel_tol=1e-12, abs_tol=1e-9)


def test_region_without_capacity_is_cut_only_by_top_k(spark):
    df, rows = _scored(spark)
    eligible = {k: sum(1 for r in rows if r[1] == k) for k in "NSE"}
    regs = spark.createDataFrame([("N", 3), ("S", None)], "region string, hr_outreach_capacity int")
    got = ranking.rank_capacity(df, regs, top_k=None).groupBy("region").count().collect()
    assert {r.region: r["count"] for r in got} == {"N": 3, "S": eligible["S"], "E": eligible["E"]}
    got = ranking.rank_capacity(df, regs, top_k=7).groupBy("region").count().collect()
    assert {r.region: r["count"] for r in got} == {"N": 3, "S": 7, "E": 7}
    summ = {r.region: r for r in ranking.rank_summary(df, regs).collect()}
    assert summ["N"].returned_count == 3 and summ["S"].hr_capacity_cap_applied is None
    assert summ["S"].returned_count == eligible["S"]


def test_ranks_beyond_the_window_group_limit(spark):
    df, rows = _scored(spark)
    regs = spark.createDataFrame([(r, 9) for r in "NSE"], "region string, hr_outreach_capacity int")
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    want = sorted(map(tuple, ranking.rank_capacity(df, regs).collect()))
    spark.conf.set(key, "4")
    try:
        assert sorted(map(tuple, ranking.rank_capacity(df, regs).collect())) == want
        assert spark.conf.get(key) == "4"
    finally:
        spark.conf.unset(key)


def test_metrics_at_row_counts_beyond_64_bits(spark):
    big = 10**11
    c = spark.createDataFrame([(0.2, big, big, 0, 0), (0.8, big, big, big, big)], "score double, pos long, neg long, pos_below long, neg_below long")
    c = c.withColumns({"pos_total": F.lit(2 * big), "neg_total": F.lit(2 * big)})
    got = metrics.auc_from_cumulative(c).first()
    assert got.roc_auc == 0.5 and got.n_pos == 2 * big
    sizes = spark.createDataFrame([(0, 3 * big), (1, big)], "enrolled int, n_c long")
    assert {r.enrolled: r.n_test for r in split.test_allocation(None, counts=sizes).collect()} == {0: 3 * big // 5, 1: big // 5}


def test_reports_of_one_class_and_of_nothing(spark):
    one = spark.createDataFrame([(0.1, 1), (0.7, 1)], "p double, enrolled int")
    none = one.limit(0)
    assert metrics.auc(one).first().roc_auc is None
    assert metrics.average_precision(one).first().average_precision == 1.0
    assert metrics.ranking_metrics(none).collect()[0].roc_auc is None
    assert metrics.threshold_metrics(none).first().accuracy is None
    assert len(metrics.classification_report(none).collect()) == 4
    assert metrics.naive_baselines(one.withColumn("has_dependents_bin", F.lit(1))).first().rule_auc is None
    from benefitlens.operators import profile
    assert profile.missing_profile(none, only_missing=False).count() == 2
    t = spark.createDataFrame([("a", 1), ("a", 0), ("b", None)], "r string, c int")
    assert [tuple(r) for r in profile.crosstab_rowpct(t, "r", "c", [0, 1]).collect()] == [("a", 0.5, 0.5)]


def test_rows_without_label_or_id_stay_outside_the_split(spark):
    rows = [(i if i % 10 else None, i % 2 if i % 7 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "employee_id int, enrolled int, n int")
    got = {r.n: r for r in split.stratified_split(df).collect()}
    assert len(got) == 200
    outside = {i for i in range(200) if i % 10 == 0 or i % 7 == 0}
    assert {n for n, r in got.items() if r.split is None} == outside
    assert all(got[n].fold is None and got[n].class_rank is None for n in outside)
    inside = [r for n, r in got.items() if n not in outside]
    assert sum(r.split == "test" for r in inside) == -(-len(inside) // 5)


def test_prefix_sums_do_not_depend_on_slices(spark):
    from benefitlens.operators.prefix import prefix_sums
    rows = [(a, b, float(i), (i % 4) or None) for i in range(80)
            for a, b in [(("x" if i % 3 else None), i % 2)]]
    df = spark.createDataFrame(rows, "a string, b int, o double, w long")

    def run(slices, groups):
        return sorted((r.o, r.w_below, r.w_total) for r in prefix_sums(df, "o", ["w"], groups, slices=slices).collect())

    for groups, same in ((["a", "b"], lambda x, y: x[:2] == y[:2]), ([], lambda x, y: True)):
        want = sorted((x[2], sum(y[3] or 0 for y in rows if same(x, y) and y[2] < x[2]), sum(y[3] or 0 for y in rows if same(x, y))) for x in rows)
        assert run(1, groups) == want and run(9, groups) == want


def test_auc_plan_has_no_single_task_window(spark):
    df, _ = _scored(spark)
    p = metrics.auc(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in p and all("_slice" in line for line in p.splitlines() if "Window [" in line)
