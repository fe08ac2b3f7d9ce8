"""Token-ID output: documents as Simple-8b coded id files, in ascending doc_id order.

A dataset is a Parquet folder whose rows are runs of whole documents (about
``RUN_IDS`` ids each): the words and the block index of ``simple8b`` as
little-endian bytes, with the documents' ids and lengths. Spark's committer makes
each file appear whole or not at all, on any file system, so a lost executor
leaves no half-written file; a mounted disk isn't needed.

Shards follow ascending doc_id (range partitioning), so reading them in the order
(shard, run) gives all ids in document order. ``start`` of a document needs only
the shards' totals, one number each.

Defined results: a null text is empty (its only id is the end id); a null doc_id
sorts first; repeated rows each have their own entry, in order of their text's
hash; an empty table gives an empty dataset; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from benefitlens.llm import simple8b
from benefitlens.llm.common import id_text, on_workers

END_ID = 2
RUN_IDS = 1 << 18

FILE_SCHEMA = "shard int, run int, shard_start bigint, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, words binary, block_index binary"
_FILE_ARROW = pa.schema([("shard", pa.int32()), ("run", pa.int32()), ("shard_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("words", pa.binary()), ("block_index", pa.binary())])


def write_token_ids(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise whole texts, append ``end_id`` to each and write the dataset to ``path``."""
    on_workers(docs.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from benefitlens.llm.tokenizer_ids import ids_of

        shard, run, before = TaskContext.get().partitionId(), 0, 0
        names, held, lengths, size = [], [], [], 0

        def row():
            words, index = simple8b.encode(np.concatenate(held))
            columns = [shard], [run], [before], [names], [lengths], [size], [words.astype("<u8").tobytes()], [index.astype("<u4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FILE_ARROW)], schema=_FILE_ARROW)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, values, sizes in ids_of(vocabulary, texts):
                ends = np.cumsum(sizes)
                values = np.insert(values, ends, end_id)
                names = names + ids[first : first + len(sizes)]
                lengths = lengths + (sizes + 1).tolist()
                held.append(values)
                size += len(values)
                if size >= RUN_IDS:
                    yield row()
                    run, before, names, held, lengths, size = run + 1, before + size, [], [], [], 0
        if names:
            yield row()

    d = id_text(docs, id_col, text_col)
    order = ["doc_id", "tie"]
    d = d.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    d.mapInArrow(runs, FILE_SCHEMA).write.parquet(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit) of each document of a dataset."""
    on_workers(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row a shard
    starts = totals.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, index = np.frombuffer(r["words"], "<u8"), np.frombuffer(r["block_index"], "<u4")
                ids = simple8b.decode(words, index, r["n_ids"]).astype("<u4")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts_here = r["before"] + r["shard_start"] + ends - lengths
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(starts_here), pa.array(lengths), pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, lengths)], pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return files.join(F.broadcast(starts), "shard").select("before", "shard_start", "doc_ids", "lengths", "n_ids", "words", "block_index").mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def ids_digest(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids' bytes, which Spark computes itself."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


