"""Models that don't depend on partitions, bins and medians from exact ranks, probes on missing values."""
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from benefitlens.plans import modeling, probes, training
from benefitlens.session import shared_path


def _rows(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rnd.gauss(0, 1), rnd.random() if rnd.random() > 0.1 else None
        out.append((i, a, b, rnd.choice(["x", "y", None]), float(a + (b or 0) + rnd.gauss(0, 0.5) > 0.4)))
    return out


def _frame(spark, n):
    return spark.createDataFrame(_rows(n), "employee_id long, a double, b double, c string, label double")


FEATURES = ["a", "b", "c"]


def test_ranks_equal_numpy(spark):
    rows = _rows(3000)
    df = _frame(spark, 3000).withColumns({"one": F.lit(5.0), "none": F.lit(None).cast("double"), "few": (F.col("employee_id") % 3).cast("double")})
    got = modeling.numeric_ranks(df, ["a", "b", "one", "none", "few"], bins=16)
    for c, i in (("a", 1), ("b", 2)):
        v = np.sort([r[i] for r in rows if r[i] is not None])
        assert got[c][0] == pytest.approx(np.median(v), rel=1e-12)
        of = np.searchsorted(v, v, "left") * 16 // len(v)
        assert got[c][1] == [v[of == k].min() for k in np.unique(of)[1:]]
    assert got["one"] == (5.0, []) and got["none"][1] == [] and got["few"] == (1.0, [1.0, 2.0])


@pytest.mark.parametrize("learner", [lambda: modeling.gbt(max_iter=4), lambda: modeling.forest(n=6, depth=4)])
def test_same_model_for_two_partitionings(spark, learner):
    """More rows than Spark searches for thresholds without sampling."""
    df = _frame(spark, 12_000)
    scores = []
    for parts in ("2", "7"):
        spark.conf.set(training.PARTITIONS_CONF, parts)
        try:
            train = training.learner_input(df.repartition(int(parts) + 3))
            assert train.rdd.getNumPartitions() == int(parts)
            model = modeling.tree_pipeline(train, learner(), FEATURES).fit(train)
            scores.append({r.employee_id: r.predicted_probability for r in modeling.score(model, df).collect()})
            train.unpersist()
        finally:
            spark.conf.unset(training.PARTITIONS_CONF)
    assert max(abs(scores[0][i] - scores[1][i]) for i in scores[0]) < 1e-9
    assert len(set(scores[0].values())) > 10


def test_default_partitions_follow_the_rows(spark, monkeypatch):
    df = _frame(spark, 900)
    assert training.learner_partitions(df) == training.LEAST_PARTITIONS
    monkeypatch.setattr(training, "ROWS_PER_PARTITION", 100)
    assert training.learner_partitions(df) == 9
    assert training.learner_input(df).rdd.getNumPartitions() == 9


def test_a_round_over_many_rows_keeps_a_dozen_cores_busy(spark):
    """The training rows of 900,000 employees took four tasks a pass."""
    assert training.learner_partitions(spark.range(720_000)) >= 12


def test_a_round_over_more_rows_takes_no_more_tasks_than_keep_the_cores_busy(spark):
    """Six times the rows took 72 tasks a pass on a dozen cores, whatever the cores."""
    busy = max(12, 2 * spark.sparkContext.defaultParallelism)
    assert training.learner_partitions(spark.range(60_000 * (busy + 1))) == busy
    assert training.learner_partitions(spark.range(600_000 * (busy + 1))) == busy + 1


def test_a_learner_reads_a_checkpoint_and_fits_the_same_model(spark):
    seen = []

    class Seen(modeling.GBTClassifier):
        def _fit(self, dataset):
            seen.append(dataset._jdf.queryExecution().executedPlan().toString())
            return super()._fit(dataset)

    train = training.learner_input(_frame(spark, 600))
    of = lambda make: modeling.tree_pipeline(train, make(labelCol="label", featuresCol="features", maxIter=4, maxBins=64, seed=1), FEATURES)
    model, plain = modeling.fit(of(Seen), train), of(modeling.GBTClassifier).fit(train)
    assert len(seen) == 1 and "ExistingRDD" in seen[0] and "InMemory" not in seen[0] and "Project" not in seen[0]
    trees = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees]
    assert trees(model) == trees(plain)
    path = shared_path(spark, "tests", f"fitted-{random.random()}")
    p = lambda m: sorted(map(str, modeling.score(m, train).collect()))
    assert p(modeling.save_and_reload(model, path)) == p(plain)
    train.unpersist()


def test_a_query_that_reads_no_test_scores_makes_no_test_split(spark, monkeypatch):
    from benefitlens import catalog

    def unwanted(*_):
        raise AssertionError("test split")
    monkeypatch.setattr(training, "final_model", lambda *_: "the model")
    monkeypatch.setattr(training, "test_frame", unwanted)
    monkeypatch.setattr(catalog, "_eng", lambda *_: None)
    assert catalog._model(spark, "") == "the model"


def test_the_final_split_is_made_once_for_the_fit_and_the_scorings(spark, monkeypatch):
    from benefitlens.constants import CATEGORICAL_LEVELS, EXPECTED_FEATURES
    calls, made, name = [], training.stratified_split, f"test-{random.getrandbits(64)}"
    monkeypatch.setattr(training, "stratified_split", lambda df: (calls.append(1), made(df))[1])
    monkeypatch.setattr(training, "input_fingerprint", lambda *_: name)
    columns = [F.lit(CATEGORICAL_LEVELS[c][0]).alias(c) if c in CATEGORICAL_LEVELS else (F.rand(3) * 9).alias(c) for c in EXPECTED_FEATURES]
    e = spark.range(60).select(F.col("id").alias("employee_id"), (F.col("id") % 2).cast("int").alias("enrolled"), *columns).checkpoint()
    test = training.final_test(spark, "", e)
    again = training.final_test(spark, "", e)
    train, _ = training.both_sides(training.final_split(spark, "", e))
    assert len(calls) == 1 and train.count() == 48
    train.unpersist()
    want = sorted(map(str, training.test_frame(e).collect()))
    assert len(want) == 12 and sorted(map(str, test.collect())) == want and sorted(map(str, again.collect())) == want


def test_fitted_preprocessing_is_saved_with_the_model(spark):
    df = _frame(spark, 400)
    path = shared_path(spark, "tests", f"exact-{random.random()}")
    model = Pipeline(stages=[modeling.ExactNumeric(["a", "b"])]).fit(df)
    model.write().save(path)
    again = PipelineModel.load(path)
    odd = spark.createDataFrame([(None, None), (float("nan"), 99.0), (-99.0, 0.5)], "a double, b double")
    got = [tuple(r) for r in again.transform(odd).select("a__imp", "b__imp", "a__bin", "b__bin").collect()]
    assert got == [tuple(r) for r in model.transform(odd).select("a__imp", "b__imp", "a__bin", "b__bin").collect()]
    medians = {c: float(np.median([r[i] for r in _rows(400) if r[i] is not None])) for i, c in ((1, "a"), (2, "b"))}
    assert got[0][:2] == pytest.approx((medians["a"], medians["b"])) and got[1][0] == pytest.approx(medians["a"])
    assert got[1][3] == 63 and got[2][2] == 0


def test_tree_probe_on_missing_values(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.uniform(3e4, 9e4) if i % 9 else None, rnd.randint(20, 60) if i % 7 else None, rnd.choice(["Yes", "No", None]), rnd.choice(["Full-time", None]), rnd.randint(0, 1) if i % 50 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "employee_id int, salary double, age int, has_dependents string, employment_type string, enrolled int")
    m = probes.tree_matrix(df)
    assert m.count() == sum(1 for r in rows if r[1] is not None and r[5] is not None)
    assert m.filter("age IS NULL OR has_dep_num IS NULL").isEmpty()
    assert {(r.has_dependents, r.has_dep_num) for r in m.join(df.select("employee_id", "has_dependents"), "employee_id").collect()} == {("Yes", 1.0), ("No", 0.0), (None, 0.0)}
    assert [r.depth for r in probes.tree_probe(df, depths=(2, 3)).collect()] == [2, 3]
