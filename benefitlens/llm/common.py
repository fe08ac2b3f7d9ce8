"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benefitlens.session import shared_path

#: Blanks as the contracts name them: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so that any other column of the input, whatever its name, is out of the way. Columns are
    found by their exact names, so others may differ from them in case only."""
    names = df.columns
    if id_col in names and text_col in names:
        df = df.toDF(*(str(i) for i in range(len(names))))
        id_col, text_col = str(names.index(id_col)), str(names.index(text_col))
    return df.select(df[id_col].cast("bigint").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def text_digest(text: Column) -> Column:
    """SHA-256 of a text (null counts as empty) as bytes."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def without_rows(docs: DataFrame, gone: DataFrame, once: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (doc_id, exact: digest of the text) isn't in ``gone``; of those in ``once`` one each.

    Ids may be null or shared: a decision is about an id together with its text. Rows are told apart by a 64-bit hash of
    both first, of which only that of the given keys travels; only rows that meet one are compared exactly, so the
    others' texts aren't moved while the keys are few enough to broadcast.
    """
    def met(keys: DataFrame) -> Column:
        return docs[id_col].cast("bigint").eqNullSafe(keys["doc_id"]) & text_digest(docs[text_col]).eqNullSafe(keys["exact"])

    both = gone.unionByName(once)
    numbers = both.select(F.xxhash64("doc_id", "exact").alias("number"))
    meets = F.xxhash64(docs[id_col].cast("bigint"), text_digest(docs[text_col])) == numbers["number"]
    near = docs.join(numbers, meets, "left_semi")
    out = docs.join(numbers, meets, "left_anti").unionByName(near.join(both.hint("merge"), met(both), "left_anti"))
    if once.isEmpty():
        return out
    name = "exact_text"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return out.unionByName(near.join(once, met(once), "left_semi").withColumn(name, F.coalesce(docs[text_col], F.lit(""))).dropDuplicates([id_col, name]).drop(name))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(spark: SparkSession) -> None:
    """Python workers import this package from the place the driver has it from (an installed package, a mounted
    checkout, or --py-files); no code is copied through a temporary folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


#: A group with this share of all rows or more is hot; at most 1 / HOT_SHARE groups are.
HOT_SHARE = 0.001


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """rows with the columns of their group (one row a key, ``size`` counts its rows), without moving hot groups.

    At most 1 / HOT_SHARE groups can hold that share of all rows each, so those are broadcast and their rows stay
    where they are; the others are joined by key.
    """
    hot_size = max(2, HOT_SHARE * rows.count())
    hot, rest = F.broadcast(groups.filter(F.col(size) >= hot_size)), groups.filter(F.col(size) < hot_size)
    cold = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(rest, key))
