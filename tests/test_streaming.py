"""The scoring job on a stream equals the batch job on the same records."""
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF0001


def test_stream_scores_equal_batch_scores(spark):
    from benefitlens import catalog as C
    from benefitlens.plans import modeling
    from benefitlens.plans.features import preprocess_scoring
    from benefitlens.plans.training import split_frames
    from benefitlens.streaming.scoring import read_record_stream, run_available_now, score_stream
    e = C._eng(spark, SF0001)
    train, _ = split_frames(e)
    model = modeling.tree_pipeline(train, modeling.gbt(max_iter=3)).fit(train)
    regs = C._reg(spark, SF0001)
    recs = C._arriving_records(spark, SF0001)
    d = tempfile.mkdtemp(prefix="bl-stream-")
    recs.repartition(3).write.parquet(f"{d}/landing")
    stream = read_record_stream(spark, f"{d}/landing", recs.schema, max_files_per_trigger=1)
    run_available_now(score_stream(stream, regs, model), f"{d}/out", f"{d}/ckpt")
    got = spark.read.parquet(f"{d}/out")
    batch = modeling.score(model, modeling.prepare(preprocess_scoring(recs, regs)))
    key = ["employee_id", "reason", F.round("predicted_probability", 9).alias("p"), "predicted_class"]
    assert sorted(map(tuple, got.select(*key).collect()), key=str) == \
        sorted(map(tuple, batch.select(*key).collect()), key=str)
    train.unpersist()
