"""Cross-validation: folds side by side, every fold once, the same figures as fold by fold."""
import random
import statistics
import threading

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from benefitlens.plans import modeling

FEATURES = ["a", "c"]


def _frame(spark, n=600):
    rnd = random.Random(3)
    values = [rnd.gauss(0, 1) for _ in range(n)]
    rows = [(i, i % 5, a if i % 11 else None, rnd.choice(["x", "y", None]), float(a + rnd.gauss(0, 1) > 0)) for i, a in enumerate(values)]
    return spark.createDataFrame(rows, "employee_id long, fold int, a double, c string, label double")


class Together(LogisticRegression):
    """Ends a fit only when all folds have begun theirs."""

    def _fit(self, dataset):
        self.begun.append(dataset.count())
        self.barrier.wait(timeout=60)
        return super()._fit(dataset)


def test_folds_run_side_by_side_and_nothing_else_is_fitted(spark):
    learner = Together(maxIter=5)
    learner.begun, learner.barrier = [], threading.Barrier(5)
    r = modeling.cross_validate(_frame(spark), learner, FEATURES, parallelism=5).first()
    assert learner.begun == [480] * 5 and 0.5 < r.cv_auc_mean < 1


def test_figures_equal_fold_by_fold(spark):
    df = _frame(spark)
    learners = {"gbt": modeling.gbt(max_iter=3), "forest": modeling.forest(n=4, depth=3)}
    got = {r.model: (r.cv_auc_mean, r.cv_auc_std) for r in modeling.cross_validate_all(df, learners, FEATURES, parallelism=5).collect()}
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0)
    for name, learner in learners.items():
        aucs = [ev.evaluate(modeling.tree_pipeline(df, learner, FEATURES).fit(df.filter(F.col("fold") != i)).transform(df.filter(F.col("fold") == i))) for i in range(5)]
        assert got[name] == pytest.approx((statistics.fmean(aucs), statistics.pstdev(aucs)), abs=1e-9)


@pytest.mark.parametrize("fold", [None, 7])
def test_rows_without_a_fold_are_refused(spark, fold):
    df = _frame(spark, 60).withColumn("fold", F.when(F.col("employee_id") == 4, F.lit(fold).cast("int")).otherwise(F.col("fold")))
    with pytest.raises(ValueError, match="1 rows have no fold"):
        modeling.cross_validate(df, modeling.gbt(max_iter=1), FEATURES)


def test_an_empty_fold_is_refused(spark):
    with pytest.raises(ValueError, match="validation data at fold 2"):
        modeling.cross_validate(_frame(spark, 60).filter("fold != 2"), modeling.gbt(max_iter=1), FEATURES)


def test_feature_sets_of_the_ablation_share_a_split_and_run_side_by_side(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression as Plain
    from benefitlens.plans import training

    rnd = random.Random(4)
    rows = [(i, rnd.choice(["train", "train", "test"]), a := rnd.gauss(0, 1), rnd.gauss(0, 1), int(a + rnd.gauss(0, 1) > 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "employee_id long, split string, a double, b double, enrolled int")
    prepared = modeling.prepare(df, ["a", "b"])
    splits, barrier = [], threading.Barrier(2)

    def one_split(engineered, features):
        splits.append(features)
        return prepared.filter("split = 'train'").persist(), prepared.filter("split = 'test'")

    def learner():
        x = Together(maxIter=5)
        x.begun, x.barrier = [], barrier
        return x
    monkeypatch.setattr(training, "split_frames", one_split)
    monkeypatch.setattr(training, "ablation_features", lambda: {"one": ["b"], "both": ["b", "a"]})
    monkeypatch.setattr(modeling, "gbt", learner)
    got = {r.variant: r for r in training.ablation(df).collect()}
    assert splits == [["b", "a"]] and {k: r.n_features for k, r in got.items()} == {"one": 1, "both": 2}
    train, test = prepared.filter("split = 'train'"), prepared.filter("split = 'test'")
    for name, features in (("one", ["b"]), ("both", ["b", "a"])):
        model = modeling.tree_pipeline(train, Plain(maxIter=5), features).fit(train)
        assert got[name].roc_auc == pytest.approx(training.evaluate(modeling.score(model, test), "x")["roc_auc"], abs=1e-9)
