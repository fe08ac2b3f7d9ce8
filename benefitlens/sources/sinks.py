"""Sinks: versioned partitioned tables and JSON rows.

A table's folder holds whole versions side by side and a folder of marks.  A
version is written first, by Spark's committer; then an empty file whose name
holds the version's number and folder marks it as finished.  Creating a file is
one step on any file system, so a reader sees the old version or the new one,
never a part: during a write, after a killed one, and when two writers race
(both versions stand, the greater mark is read).  Readers that opened an older
version go on reading it until ``vacuum`` removes it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "_versions"


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the finished versions, oldest first."""
    hadoop, fs = _filesystem(spark, path)
    marks = hadoop(f"{path}/{MARKS}")
    if not fs.exists(marks):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(marks))
    found = [re.fullmatch(r"(\d{12})-(\w+)", n) for n in names]
    return [(int(m[1]), m[2]) for m in found if m]


def write_version(df: DataFrame, path: str, *partition_by: str, fmt: str = "parquet") -> str:
    """Writes ``df`` as the table's next version and returns its folder's name."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).format(fmt).save(f"{path}/{name}")
    mark_version(spark, path, name)
    return name


def mark_version(spark: SparkSession, path: str, name: str) -> None:
    """Makes the folder ``name`` of the table visible as its next version."""
    hadoop, fs = _filesystem(spark, path)
    number = max((n for n, _ in versions(spark, path)), default=0) + 1
    fs.create(hadoop(f"{path}/{MARKS}/{number:012d}-{name}"), False).close()


def read_version(spark: SparkSession, path: str, version: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The newest finished version, or the named one."""
    known = [name for _, name in versions(spark, path)]
    if not known or version not in (None, *known):
        raise FileNotFoundError(f"no finished version {version or ''} in {path}")
    return spark.read.format(fmt).load(f"{path}/{version or known[-1]}")


def vacuum(spark: SparkSession, path: str, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
    """Removes all but the ``keep`` newest versions, marks first, and folders of
    unfinished writes that haven't changed for ``grace_hours``.  Returns them."""
    import time
    hadoop, fs = _filesystem(spark, path)
    if not fs.exists(hadoop(path)):
        return []
    marked = versions(spark, path)
    old = marked[: max(0, len(marked) - max(keep, 1))]
    for number, name in old:
        fs.delete(hadoop(f"{path}/{MARKS}/{number:012d}-{name}"), False)
    known = {name for _, name in marked}
    limit = (time.time() - 3600 * grace_hours) * 1000
    stale = [s.getPath().getName() for s in fs.listStatus(hadoop(path))
             if s.getPath().getName() not in {MARKS, *known} and s.getModificationTime() < limit]
    gone = [name for _, name in old] + stale
    for name in gone:
        fs.delete(hadoop(f"{path}/{name}"), True)
    return gone


def write_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """IO5: one write, partitioned by ``split`` so readers prune partitions.

    ``repartition('split')`` is avoided on purpose: with two split values it
    would funnel the whole table into two tasks.  Each task writes its own
    rows into both partition folders instead.
    """
    write_version(df, path, "split", fmt=fmt)


def read_splits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Both sides of the newest finished split."""
    return read_version(spark, path, fmt=fmt)


def read_split(spark: SparkSession, path: str, split: str, fmt: str = "parquet") -> DataFrame:
    """IO6: read one side back; the ``split`` filter prunes the other folder."""
    return read_splits(spark, path, fmt).filter(F.col("split") == F.lit(split))


def json_rows(df: DataFrame, column: str = "json") -> DataFrame:
    """IO7: one JSON document per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(column))
