"""Score arriving records as a stream (C2 + M11 on a streaming DataFrame).

The scoring-time feature job is row-local apart from a static dimension
join, so the very same function runs on a stream: no state, no watermark.
Each micro-batch is written to a file sink whose checkpoint lives in the
shared checkpoint folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benefitlens.plans import modeling
from benefitlens.plans.features import preprocess_scoring


def read_record_stream(spark: SparkSession, landing: str, schema, max_files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files dropped into ``landing`` become a stream of records."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(landing))


def preprocess_stream(records: DataFrame, regions: DataFrame) -> DataFrame:
    """C2 on a stream: validation reason, defaults, features, fixed domains."""
    return preprocess_scoring(records, regions)


def score_stream(records: DataFrame, regions: DataFrame, model) -> DataFrame:
    """C2 + M11 on a stream; the PipelineModel transforms each micro-batch."""
    return modeling.score(model, modeling.prepare(preprocess_scoring(records, regions)))


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now, then stop (batch-like, restartable)."""
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
