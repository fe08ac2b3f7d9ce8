"""Spark ML pipelines around the learners (M1-M11, M19, M22, M24, IO8).

Preprocessing lives inside the PipelineModel, so a saved model scores raw
feature rows by itself.  Categorical columns are indexed alphabetically with
an extra slot for unseen levels; numeric columns are median-imputed on the
training rows (Spark trees have no native null branch).  Scores are carried
with ``employee_id`` and joined by key, never by position (G15).

A model depends on its training rows, not on how they are partitioned: medians
and the trees' bins come from exact ranks (``ExactNumeric``) where Spark's
Imputer and its search for thresholds sample rows by partition, and forests
take all rows for every tree and differ by the features each node may use,
where a bootstrap would be drawn by partition.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (Bucketizer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benefitlens.constants import EXPECTED_FEATURES, SPLIT_SEED
from benefitlens.operators.prefix import prefix_sums
from benefitlens.session import ensure_checkpoint_dir

LABEL = "enrolled"


def _categorical(df: DataFrame, features) -> list[str]:
    return [c for c in features if isinstance(df.schema[c].dataType, T.StringType)]


def prepare(df: DataFrame, features=EXPECTED_FEATURES) -> DataFrame:
    """Numeric features as double (Imputer needs floating columns), label as double."""
    cats = set(_categorical(df, features))
    cols = [F.col(c) if c in cats else F.col(c).cast("double").alias(c) for c in features]
    extra = [c for c in ["employee_id", LABEL, "split", "fold", "reason"] if c in df.columns]
    out = df.select(*extra, *cols)
    if LABEL in out.columns:
        out = out.withColumn("label", F.col(LABEL).cast("double"))
    return out


def _indexer(cats):
    """One multi-column indexer (one pass for all categorical columns);
    alphabetical order, with an extra index for unseen or missing levels."""
    if not cats:
        return []
    return [StringIndexer(inputCols=list(cats), outputCols=[f"{c}__idx" for c in cats], handleInvalid="keep",
                          stringOrderType="alphabetAsc")]


#: Bins of a numeric feature, as many as a tree considers.
BINS = 64


def numeric_ranks(df: DataFrame, columns, bins: int = BINS) -> dict[str, tuple[float, list[float]]]:
    """Exact (median, least value of each bin but the first) of numeric columns,
    from one distributed scan; at most ``bins`` numbers a column reach the driver.
    A value's bin is the ``bins``-tile of the rows below it."""
    columns = list(columns)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "_v")
    known = F.col("_v").isNotNull() & ~F.isnan("_v")
    hist = long.filter(known).groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_c"))
    n, below = F.col("_c_total"), F.col("_c_below")
    covers = lambda k: F.when((below <= k) & (k < below + F.col("_c")), F.col("_v"))
    rows = (prefix_sums(hist, "_v", ["_c"], ["column_name"])
            .groupBy("column_name", F.floor(below * F.lit(bins) / n).cast("int").alias("bin"))
            .agg(F.min("_v").alias("least"), F.max(covers(F.floor((n - 1) / 2))).alias("low"), F.max(covers(F.floor(n / 2))).alias("high")).collect())
    out = {}
    for c in columns:
        mine = sorted((r for r in rows if r["column_name"] == c), key=lambda r: r["bin"])
        low, high = [next((r[k] for r in mine if r[k] is not None), 0.0) for k in ("low", "high")]
        out[c] = low + (high - low) / 2, [r["least"] for r in mine[1:]]
    return out


class ExactNumeric(Estimator):
    """Numeric columns with missing values as the training rows' exact median
    (``<c>__imp``), and, with ``bins``, as the number of the value's bin (``<c>__bin``).

    Fits to plain Spark transformers, so the fitted pipeline is saved and loaded as any other.
    """

    def __init__(self, columns, bins: int | None = BINS):
        super().__init__()
        self.columns, self.bins = list(columns), bins

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        ranks = numeric_ranks(dataset, self.columns, self.bins or BINS)
        filled = ", ".join(f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {ranks[c][0]!r}D) AS `{c}__imp`" for c in self.columns)
        stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")]
        if self.bins:
            ends = float("inf")
            # a bucketizer needs a cut; a constant column has none
            cuts = [[-ends, *(ranks[c][1] or [1.7e308]), ends] for c in self.columns]
            stages.append(Bucketizer(splitsArray=cuts, inputCols=[f"{c}__imp" for c in self.columns],
                                     outputCols=[f"{c}__bin" for c in self.columns], handleInvalid="keep"))
        return PipelineModel(stages)


def _stages_trees(df: DataFrame, features):
    cats = _categorical(df, features)
    nums = [c for c in features if c not in cats]
    idx = _indexer(cats)
    imp = [ExactNumeric(nums)] if nums else []
    asm = VectorAssembler(inputCols=[f"{c}__bin" for c in nums] + [f"{c}__idx" for c in cats],
                          outputCol="features", handleInvalid="keep")
    return idx + imp + [asm], [f"{c}" for c in nums] + cats


def _stages_linear(df: DataFrame, features):
    cats = _categorical(df, features)
    nums = [c for c in features if c not in cats]
    idx = _indexer(cats)
    ohe = [OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__ohe" for c in cats],
                         dropLast=True, handleInvalid="keep")] if cats else []
    imp = [ExactNumeric(nums, bins=None)] if nums else []
    num_vec = VectorAssembler(inputCols=[f"{c}__imp" for c in nums], outputCol="num_vec")
    scaler = StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True)
    asm = VectorAssembler(inputCols=["num_scaled"] + [f"{c}__ohe" for c in cats], outputCol="features")
    return idx + ohe + imp + [num_vec, scaler, asm]


def gbt(max_iter=150, step=0.05, depth=5, seed=SPLIT_SEED) -> GBTClassifier:
    """M3: the final boosted-trees setting (150 trees, rate 0.05, depth 5)."""
    return GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter,
                         stepSize=step, maxDepth=depth, seed=seed, maxBins=64)


def gbt_default(seed=SPLIT_SEED) -> GBTClassifier:
    """M2: default boosting baseline (100 trees, rate 0.1)."""
    return gbt(max_iter=100, step=0.1, depth=5, seed=seed)


def forest(n=150, depth=5, seed=SPLIT_SEED) -> RandomForestClassifier:
    """M4: a second tree ensemble for comparison (all rows for every tree, random features for every node)."""
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=n, bootstrap=False,
                                  subsamplingRate=1.0, maxDepth=depth, seed=seed, maxBins=64)


def tree_pipeline(df: DataFrame, learner, features=EXPECTED_FEATURES) -> Pipeline:
    stages, _ = _stages_trees(df, features)
    return Pipeline(stages=stages + [learner])


def logistic_pipeline(df: DataFrame, n_train: int, features=EXPECTED_FEATURES) -> Pipeline:
    """M1: one-hot + standardise + L2 logistic regression (C = 1 in the
    sum-of-losses form, i.e. ``regParam = 1 / n``), at most 1000 iterations
    and a 1e-4 tolerance, the reference learner's settings."""
    lr = LogisticRegression(labelCol="label", featuresCol="features", maxIter=1000, tol=1e-4,
                            regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                            standardization=False)
    return Pipeline(stages=_stages_linear(df, features) + [lr])


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of class 1 and class at ``p >= threshold``."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    keep = [c for c in ["employee_id", LABEL, "split", "reason"] if c in df.columns]
    res = out.select(*keep, p.alias("predicted_probability"))
    cls = (F.col("predicted_probability") >= threshold).cast("int")
    return res.withColumns({"predicted_class": cls,
                            "enrollment_probability": F.col("predicted_probability"),
                            "predicted_enrolled": cls})


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """``pipeline.fit(train)``, whose last stage, the learner, reads a checkpoint of its label and features.

    Every task of a boosting pass carries the lineage of the learner's input;
    the checkpoint ends it, where the split's and the preprocessing's plans
    went along with each of them.
    """
    ensure_checkpoint_dir(train.sparkSession)
    *stages, learner = pipeline.getStages()
    prep = Pipeline(stages=stages).fit(train)
    ready = prep.transform(train).select(learner.getLabelCol(), learner.getFeaturesCol()).checkpoint(eager=True)
    return PipelineModel([*prep.stages, learner.fit(ready)])


def concurrently(spark, jobs, parallelism: int) -> list:
    """Results of callables in their order, at most ``parallelism`` at a time, each with the caller's local properties."""
    from multiprocessing.pool import ThreadPool
    from pyspark import inheritable_thread_target
    with ThreadPool(processes=max(1, min(parallelism, len(jobs)))) as pool:
        tasks = [pool.apply_async(inheritable_thread_target(spark)(job)) for job in jobs]
        return [t.get() for t in tasks]


def cross_validate(df: DataFrame, learner, features=EXPECTED_FEATURES, parallelism: int = 2,
                   n_folds: int = 5) -> DataFrame:
    """M5: k-fold AUC on a precomputed stratified ``fold`` column.

    The evaluator uses exact AUC (``numBins=0``, no down-sampling of the curve).
    """
    return cross_validate_all(df, {"": learner}, features, parallelism, n_folds).drop("model")


def cross_validate_all(df: DataFrame, learners: dict, features=EXPECTED_FEATURES, parallelism: int = 2,
                       n_folds: int = 5) -> DataFrame:
    """``cross_validate`` of several learners, by name in ``model``.

    Folds run side by side, ``parallelism`` of them at a time: a fit is a long
    chain of short jobs, which alone leaves most of a cluster idle
    (``CrossValidator`` takes fold after fold and then fits all rows once more).
    A fold's preprocessing is fitted once, on its training rows, for all learners.
    """
    spark = df.sparkSession
    in_range = F.coalesce((F.col("fold") >= 0) & (F.col("fold") < n_folds), F.lit(False))
    rows_of = {r["fold"]: r["n"] for r in df.groupBy(F.when(in_range, F.col("fold")).alias("fold")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if None in rows_of:
        raise ValueError(f"{rows_of[None]} rows have no fold in range [0, {n_folds})")
    for i in range(n_folds):
        if not rows_of.get(i):
            raise ValueError(f"The validation data at fold {i} is empty.")
        if sum(rows_of.values()) == rows_of[i]:
            raise ValueError(f"The training data at fold {i} is empty.")
    stages, _ = _stages_trees(df, features)
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability",
                                       metricName="areaUnderROC", numBins=0)

    def of_fold(i):
        def run():
            prep = Pipeline(stages=stages).fit(df.filter(F.col("fold") != i))
            ready = prep.transform(df).select("label", "features", "fold").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                train, valid = ready.filter(F.col("fold") != i), ready.filter(F.col("fold") == i)
                return [float(ev.evaluate(x.fit(train).transform(valid))) for x in learners.values()]
            finally:
                ready.unpersist()
        return run

    aucs = concurrently(spark, [of_fold(i) for i in range(n_folds)], parallelism)
    rows = []
    for k, name in enumerate(learners):
        of = [a[k] for a in aucs]
        mean = sum(of) / n_folds
        rows.append((mean, (sum((a - mean) ** 2 for a in of) / n_folds) ** 0.5, name))
    return spark.createDataFrame(rows, "cv_auc_mean double, cv_auc_std double, model string")


def feature_importance(model: PipelineModel, names) -> DataFrame:
    """The fitted ensemble's gain importances and the number of its splits
    on each feature, zipped to the assembled names."""
    import re
    from collections import Counter
    from pyspark.sql import SparkSession
    ensemble = model.stages[-1]
    imp = ensemble.featureImportances.toArray().tolist()
    # each split is written once as the If branch of its tree
    splits = Counter(int(k) for t in ensemble.trees for k in re.findall(r"If \(feature (\d+) ", t.toDebugString))
    spark = SparkSession.getActiveSession()
    rows = sorted(((n, float(v), splits[i]) for i, (n, v) in enumerate(zip(names, imp))), key=lambda r: -r[1])
    return spark.createDataFrame([(n, v, s, i + 1) for i, (n, v, s) in enumerate(rows)],
                                 "feature string, importance double, split_count int, rank int")


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    """IO8: persist the whole pipeline (preprocessing included) and load it."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
