"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. The number of buckets follows the
counted rows and is kept with the index: once buckets would hold too many rows, all
rows are written anew into four times as many, and a mark makes these the index. A batch of documents is
reduced to digests, the best row of each digest is found by a partial aggregate,
a sort-merge anti-join against the index (whose side needs neither shuffle nor
sort) leaves the new ones, and these are appended. Texts are never moved: only
digests, ids and lengths are.

Joining the decisions back to the rows is where a hot group would land in one
task; ``join_groups`` leaves the rows of hot groups where they are.

Defined results: a null text is empty; equal texts are equal after deleting the
blanks; of equal texts the longest original stays, then the smallest doc_id (null
last), then one of the repeated rows; each row has its own decision; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benefitlens.llm.common import BLANKS, fresh_folder, id_text, join_groups, text_digest, without_rows, written
from benefitlens.sources.sinks import mark_version, versions

#: Rows of a bucket before there are more buckets, and the most buckets that Spark reads as such (in powers of four).
ROWS_PER_BUCKET, MOST_BUCKETS = 2_000_000, 65_536
INDEX_SCHEMA = "digest STRING, keep_id BIGINT, keep_row BIGINT, batch STRING"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the text without blanks, code points of the text, its exact digest, and a number for each row."""
    d = id_text(docs, id_col, text_col)
    bare = F.regexp_replace("text", f"[{BLANKS}]+", "")
    return d.select("doc_id", F.sha2(bare, 256).alias("digest"), F.char_length("text").cast("bigint").alias("n_chars"), text_digest(d["text"]).alias("exact"), F.monotonically_increasing_id().alias("row"))


class DigestIndex:
    """A digest index at ``path``; made on first use, opened again by the same path in any later session.

    Each number of buckets is a folder of its own, whose name holds the number; the newest marked one is the index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.path, self.buckets, self.rows_per_bucket = spark, path, buckets, rows_per_bucket
        known = versions(spark, path)
        if known:
            self._open(known[-1][1])
        else:
            self._begin(buckets)

    def _open(self, folder: str) -> None:
        self.buckets, self.folder, self.table = int(re.match(r"b(\d+)_", folder)[1]), f"{self.path}/{folder}", f"digest_index_{folder}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'")

    def _begin(self, buckets: int, rows: DataFrame | None = None) -> None:
        folder = f"b{buckets}_{uuid.uuid4().hex}"
        self._open(folder)
        if rows is not None:
            self._save(rows, self.table, self.folder)
        mark_version(self.spark, self.path, folder)

    def fit(self, more: int) -> None:
        """Enough buckets for this many rows more."""
        held, needed = self.rows().count(), self.buckets
        while needed * self.rows_per_bucket < held + more and needed * 4 <= MOST_BUCKETS:
            needed *= 4
        if needed > self.buckets:
            self._begin(needed, self.rows() if held else None)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def stage(self, best: DataFrame) -> DataFrame:
        """``best`` as a table in buckets like the index's, so that joins of the two need no further shuffle. Only its
        files stay, not its name in the catalogue."""
        path = fresh_folder(self.spark, "staged-digests")
        name = f"staged_{path[-12:]}"
        self._save(best, name, path)
        staged = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return staged

    def _save(self, rows: DataFrame, name: str, path: str) -> None:
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet").option("path", path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name))

    def missing(self, staged: DataFrame) -> DataFrame:
        """The staged rows whose digest the index doesn't hold, bucket by bucket."""
        return staged.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, staged: DataFrame, batch: str) -> None:
        """Appends what is missing of the staged rows; written first, since a table can't be appended to while it's read."""
        fresh = written(self.missing(staged).select("digest", "keep_id", "keep_row", F.lit(batch).alias("batch")), "fresh-digests")
        self._save(fresh, self.table, self.folder)


def best_rows(rows: DataFrame) -> DataFrame:
    """digest, group_size and the row that stays, by aggregates that Spark combines before the shuffle."""
    order = F.struct((-F.col("n_chars")).alias("length"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    return best.select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))


def decisions(rows: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """``rows`` (see ``digests``, written) with keep_id, group_size and kept; the index grows by what is new."""
    index.fit(rows.count())
    best = index.stage(best_rows(rows))
    index.append(best, batch)
    held = index.rows().select("digest", "keep_id", F.when(F.col("batch") == batch, F.col("keep_row")).alias("keep_row"))
    decided = best.select("digest", "group_size").join(held.hint("merge"), "digest")
    return join_groups(rows, decided, "digest", "group_size").withColumn("kept", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)))


def dedup(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, row for each row of the batch; the index grows by what is new.

    group_size counts the batch's rows. A text that the index held before keeps none of the batch's rows.
    """
    rows = written(digests(docs, id_col, text_col).drop("exact"), "digests")
    return decisions(rows, index, batch).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"), "row")


def without_copies(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows that repeat both doc_id and text, one stays if
    any does, and which of them isn't defined."""
    rows = written(digests(docs, id_col, text_col), "digests")
    keys = decisions(rows, index, batch).groupBy("doc_id", "exact").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    keys = written(keys.filter("NOT kept OR n > 1"), "not-kept")
    return without_rows(docs, keys.filter("NOT kept"), keys.filter("kept"), id_col, text_col)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""
