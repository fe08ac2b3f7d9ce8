"""Diagnostic model probes (M6-M9): tree probes, forest screen, null-vs-sentinel CV."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.operators.encode import category_codes, label_encode_all
from benefitlens.operators.impute import median_impute
from benefitlens.operators.split import stratified_folds
from benefitlens.plans import modeling
from benefitlens.plans.features import sentinel_variant
from benefitlens.plans.training import learner_input

PROBE_COLUMNS = ["salary", "age", "has_dep_num", "emp_type_num"]


def tree_matrix(dedup: DataFrame) -> DataFrame:
    """Four raw columns (salary, age, dependents 0/1, employment code) and the label.

    Rows without salary or label are left out; a missing ``has_dependents``
    counts as no, a missing age as the median.
    """
    known = dedup.filter(F.col("salary").isNotNull() & F.col("enrolled").isNotNull())
    d = category_codes(median_impute(known, ["age"]), "employment_type")
    return d.select("employee_id", F.col("salary").cast("double").alias("salary"),
                    F.coalesce("age_imputed", F.lit(0.0)).alias("age"),
                    F.coalesce((F.col("has_dependents") == "Yes").cast("double"), F.lit(0.0)).alias("has_dep_num"),
                    F.col("employment_type_code").cast("double").alias("emp_type_num"),
                    F.col("enrolled").cast("double").alias("label"))


def tree_accuracy(frame: DataFrame, depth: int):
    """Fit a depth-limited tree and return (model, training accuracy)."""
    data = VectorAssembler(inputCols=PROBE_COLUMNS, outputCol="features").transform(frame)
    m = DecisionTreeClassifier(maxDepth=depth, seed=42, labelCol="label").fit(data)
    acc = m.transform(data).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    return m, float(acc)


def tree_probe(dedup: DataFrame, depths=(4, 5, 10)) -> DataFrame:
    """M7: how well shallow trees recover the label from four raw columns."""
    frame = tree_matrix(dedup).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for depth in depths:
        m, acc = tree_accuracy(frame, depth)
        rows.append((depth, acc, m.numNodes, m.toDebugString))
    frame.unpersist()
    return dedup.sparkSession.createDataFrame(rows, "depth int, accuracy double, n_nodes int, rules string")


def tree_depth_sweep(dedup: DataFrame, depths=range(1, 8)) -> DataFrame:
    """M8: training accuracy per depth on one persisted frame."""
    frame = tree_matrix(dedup).persist(StorageLevel.MEMORY_AND_DISK)
    rows = [(d, tree_accuracy(frame, d)[1]) for d in depths]
    frame.unpersist()
    return dedup.sparkSession.createDataFrame(rows, "depth int, accuracy double")


def forest_importance(raw: DataFrame, n_trees: int = 100) -> DataFrame:
    """M9: random-forest importances over all label-encoded raw columns."""
    enc = label_encode_all(raw)
    feats = [c for c in enc.columns if c not in ("employee_id", "enrolled")]
    frame = learner_input(enc.withColumn("label", F.col("enrolled").cast("double")).filter(F.col("label").isNotNull()))
    stages = [modeling.ExactNumeric(feats), VectorAssembler(inputCols=[f"{c}__bin" for c in feats], outputCol="features"),
              modeling.forest(n=n_trees)]
    m = Pipeline(stages=stages).fit(frame).stages[-1]
    frame.unpersist()
    rows = sorted(zip(feats, m.featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    return raw.sparkSession.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(rows)],
                                            "feature string, importance double, rank int")


SENTINEL_FEATURES = ["age", "salary", "tenure_years", "days_contact_to_app", "has_application_date"]


def sentinel_experiment(engineered: DataFrame) -> DataFrame:
    """M6: the small matrix with the day gap left null (imputed, with the
    has_application_date indicator) or filled with -999, cross-validated with
    both ensembles (100 trees each, boosting rate 0.1)."""
    learners = {"gbt": lambda: modeling.gbt(max_iter=100, step=0.1), "forest": lambda: modeling.forest(n=100)}
    rows = []
    for name, sentinel in [("null", None), ("sentinel_-999", -999.0)]:
        v = stratified_folds(sentinel_variant(engineered, sentinel))
        prepared = learner_input(modeling.prepare(v, SENTINEL_FEATURES).checkpoint(eager=True))
        try:
            found = modeling.cross_validate_all(prepared, {n: make() for n, make in learners.items()}, SENTINEL_FEATURES, parallelism=5)
            rows += [(name, r["model"], r["cv_auc_mean"], r["cv_auc_std"]) for r in found.collect()]
        finally:
            prepared.unpersist()
    return engineered.sparkSession.createDataFrame(
        rows, "variant string, model string, cv_auc_mean double, cv_auc_std double")
