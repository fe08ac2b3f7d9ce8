"""Training / evaluation jobs: split -> fit on train -> score test -> metrics.

The prepared training rows are persisted while an iterative learner runs
(each boosting round re-reads them); scores stay keyed by ``employee_id``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benefitlens.constants import EXPECTED_FEATURES, PROTECTED_ATTRIBUTES
from benefitlens.operators import metrics as M
from benefitlens.operators.split import stratified_folds, stratified_split
from benefitlens.plans import modeling
from benefitlens.plans.features import apply_domains
from benefitlens.session import ensure_checkpoint_dir
from benefitlens.sources.tables import input_fingerprint, path_exists


#: Session setting for the number of partitions of a learner's input; without it, one for about
#: so many rows, and a few at least. A round's passes over so many rows take longer than their tasks' overhead.
PARTITIONS_CONF, ROWS_PER_PARTITION, LEAST_PARTITIONS = "spark.benefitlens.learner.partitions", 60_000, 4
#: Once every core has two tasks a pass (a dozen tasks at least), partitions grow up to so many rows before there are more of them.
TASKS_PER_CORE, FEW_TASKS, MOST_ROWS_PER_PARTITION = 2, 12, 600_000


def learner_partitions(df: DataFrame) -> int:
    """As many as the rows ask for: iterative learners run several jobs a round,
    so near-empty partitions only add task overhead, and full ones leave a
    cluster idle.  More tasks than keep all cores busy add overhead to every
    pass as well.  The models don't depend on it (``modeling``)."""
    wanted = df.sparkSession.conf.get(PARTITIONS_CONF, None)
    if wanted:
        return int(wanted)
    rows = df.count()
    busy = max(FEW_TASKS, TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    return max(LEAST_PARTITIONS, min(busy, -(-rows // ROWS_PER_PARTITION)), -(-rows // MOST_ROWS_PER_PARTITION))


def learner_input(df: DataFrame, key: str = "employee_id") -> DataFrame:
    """Persist a learner's input, dealt by a hash of the id."""
    n = learner_partitions(df)
    return df.repartition(n, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)


def split_frames(engineered: DataFrame, features=EXPECTED_FEATURES):
    """Prepared (train, test) frames from one stratified split.

    The prepared split is checkpointed to the shared folder once: the fit, the
    row count and the test scoring then read that table instead of each
    recomputing the split (its ranking scan included), and an iterative fit
    no longer depends on the split's lineage when an executor is lost.
    """
    ensure_checkpoint_dir(engineered.sparkSession)
    return both_sides(_prepared(engineered, features).checkpoint(eager=True))


def _prepared(engineered: DataFrame, features=EXPECTED_FEATURES) -> DataFrame:
    return modeling.prepare(apply_domains(stratified_split(engineered)), features)


def both_sides(prepared: DataFrame):
    """(learner input of the train rows, test rows) of a prepared split."""
    return learner_input(prepared.filter(F.col("split") == "train")), prepared.filter(F.col("split") == "test")


def final_split(spark, sf_dir: str, engineered: DataFrame) -> DataFrame:
    """The final model's prepared split, written to the shared folder once per
    input: the fit and every scoring of the test rows read that table, where
    each of them made the split anew."""
    from benefitlens.session import shared_path
    from benefitlens.sources.fixtures import _publish
    path = shared_path(spark, "splits", f"{_model_key()}-{input_fingerprint(spark, sf_dir)}")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        _publish(spark, _prepared(engineered), path)
    return spark.read.parquet(path)


def final_test(spark, sf_dir: str, engineered: DataFrame) -> DataFrame:
    """The final model's prepared test rows."""
    return final_split(spark, sf_dir, engineered).filter(F.col("split") == "test")


def test_frame(engineered: DataFrame, features=EXPECTED_FEATURES) -> DataFrame:
    """Prepared test rows only (nothing persisted), for scoring a fitted model."""
    return _prepared(engineered, features).filter(F.col("split") == "test")


def evaluate(scored: DataFrame, name: str) -> dict:
    """Test-split metrics of one model as a dict of scalars."""
    s = scored.select(F.col("predicted_probability").alias("p"), F.col("enrolled")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    out = {"model": name}
    out.update(M.ranking_metrics(s).first().asDict())
    pw = M.pointwise_metrics(s).first().asDict()
    out.update({k: pw[k] for k in ("accuracy", "precision", "recall", "f1", "brier", "log_loss")})
    s.unpersist()
    return out


METRIC_SCHEMA = ("model string, roc_auc double, average_precision double, accuracy double, precision double, "
                 "recall double, f1 double, brier double, log_loss double")


def metrics_frame(spark, rows) -> DataFrame:
    cols = ["model", "roc_auc", "average_precision", "accuracy", "precision", "recall", "f1", "brier", "log_loss"]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], METRIC_SCHEMA)


def fit_and_score(engineered: DataFrame, learner_name: str = "gbt", features=EXPECTED_FEATURES):
    """Fit one learner on the train split; return (model, scored test, train)."""
    train, test = split_frames(engineered, features)
    if learner_name == "logistic":
        pipe = modeling.logistic_pipeline(train, train.count(), features)
    else:
        learner = {"gbt": modeling.gbt, "gbt_default": modeling.gbt_default,
                   "forest": modeling.forest}[learner_name]()
        pipe = modeling.tree_pipeline(train, learner, features)
    model = modeling.fit(pipe, train)
    return model, modeling.score(model, test), train


def train_and_evaluate(engineered: DataFrame, learner_name: str, features=EXPECTED_FEATURES) -> dict:
    model, scored, train = fit_and_score(engineered, learner_name, features)
    try:
        return evaluate(scored, learner_name)
    finally:
        train.unpersist()


def cross_validate(engineered: DataFrame, *learner_names: str, features=EXPECTED_FEATURES,
                   n_folds: int = 5) -> DataFrame:
    """M5 on the train split, with stratified folds assigned on the train rows; one row per learner."""
    s = stratified_split(engineered).filter(F.col("split") == "train").drop("fold", "class_rank")
    folded = apply_domains(stratified_folds(s, n_folds=n_folds))
    prepared = learner_input(modeling.prepare(folded, features).checkpoint(eager=True))
    make = {"gbt": modeling.gbt, "gbt_default": modeling.gbt_default, "forest": modeling.forest}
    try:
        return modeling.cross_validate_all(prepared, {n: make[n]() for n in learner_names or ("gbt",)}, features,
                                           parallelism=n_folds, n_folds=n_folds)
    finally:
        prepared.unpersist()


def ablation_features():
    """The 20 features, plus demographics, plus the leaky column."""
    base = list(EXPECTED_FEATURES)
    return {"without_demographics": base,
            "with_demographics": base + PROTECTED_ATTRIBUTES,
            "with_leaky_column": base + ["legacy_propensity_score"]}


def ablation(engineered: DataFrame) -> DataFrame:
    """Test AUC of the boosted model for each feature set.

    One split and one learner input with the features of all sets; the fits run side by side.
    """
    sets = ablation_features()
    every = list(dict.fromkeys(f for features in sets.values() for f in features))
    train, test = split_frames(engineered, every)

    def of_set(name, features):
        model = modeling.fit(modeling.tree_pipeline(train, modeling.gbt(), features), train)
        return name, evaluate(modeling.score(model, test), "gbt")["roc_auc"], len(features)

    spark = engineered.sparkSession
    try:
        rows = modeling.concurrently(spark, [lambda s=s: of_set(*s) for s in sets.items()], len(sets))
    finally:
        train.unpersist()
    return spark.createDataFrame(rows, "variant string, roc_auc double, n_features int")


MODEL_VERSION = "gbt-150-0.05-5-v4"
#: Written last into a model's folder: a folder without it was never finished.
MODEL_MARK = "_COMPLETE"


def _model_key() -> str:
    """Changes with the fixture's text, the features and the domains, so that no older model is served."""
    import hashlib
    from benefitlens.constants import CATEGORICAL_LEVELS
    from benefitlens.sources.fixtures import EMP_RAW_SQL, REGION_PROFILE_SQL
    text = repr((EMP_RAW_SQL, REGION_PROFILE_SQL, list(EXPECTED_FEATURES), CATEGORICAL_LEVELS))
    return f"{MODEL_VERSION}-{hashlib.md5(text.encode()).hexdigest()[:12]}"


def publish_model(spark, model, path: str) -> None:
    """Save to a fresh folder, mark it finished, then rename it into place: a job
    killed while saving leaves nothing that a later one would load, and of two
    jobs that race the first rename wins."""
    import uuid
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    model.write().save(tmp)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    src, dst = hadoop(tmp), hadoop(path)
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(hadoop(f"{tmp}/{MODEL_MARK}")).close()
    if fs.exists(dst) and not fs.exists(hadoop(f"{path}/{MODEL_MARK}")):
        fs.delete(dst, True)  # unfinished
    if fs.exists(dst) or not fs.rename(src, dst):
        fs.delete(src, True)


def final_model(spark, sf_dir: str, engineered: DataFrame):
    """M3 fitted once per input: later jobs load it from the shared folder
    instead of refitting (fit once, score many times)."""
    from pyspark.ml import PipelineModel
    from benefitlens.session import shared_path
    path = shared_path(spark, "models", f"{_model_key()}-{input_fingerprint(spark, sf_dir)}")
    if path_exists(spark, f"{path}/{MODEL_MARK}"):
        return PipelineModel.load(path)
    train, _ = both_sides(final_split(spark, sf_dir, engineered))
    try:
        model = modeling.fit(modeling.tree_pipeline(train, modeling.gbt()), train)
    finally:
        train.unpersist()
    publish_model(spark, model, path)
    return model
