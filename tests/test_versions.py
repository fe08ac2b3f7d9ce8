"""Versioned tables: readers see whole versions only."""
import os
import time

import pytest
from pyspark.sql import functions as F

from benefitlens.session import shared_path
from benefitlens.sources import sinks


def _table(spark, tag, n):
    return spark.range(n).select("id", F.lit(tag).alias("tag"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))


@pytest.fixture
def path(spark, request):
    return shared_path(spark, "tests", f"{request.node.name}-{time.time_ns()}")


def _local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_reader_during_a_write_sees_the_old_version(spark, path):
    sinks.write_splits(_table(spark, "a", 100), path)
    opened = sinks.read_splits(spark, path)
    assert sinks.read_split(spark, path, "test").count() == 20
    name = "unfinished"
    _table(spark, "b", 50).write.partitionBy("split").parquet(f"{path}/{name}")  # written, not yet marked
    assert sinks.read_splits(spark, path).agg(F.min("tag"), F.count("*")).first() == ("a", 100)
    sinks.mark_version(spark, path, name)
    assert sinks.read_splits(spark, path).agg(F.min("tag"), F.count("*")).first() == ("b", 50)
    assert opened.agg(F.min("tag"), F.count("*")).first() == ("a", 100)  # opened before, still whole


def test_a_killed_write_leaves_the_old_version(spark, path):
    sinks.write_splits(_table(spark, "a", 100), path)
    broken = _table(spark, "b", 40).withColumn("id", F.expr("CASE WHEN id = 39 THEN raise_error('killed') ELSE id END").cast("long"))
    with pytest.raises(Exception, match="killed"):
        sinks.write_splits(broken, path)
    assert sinks.read_splits(spark, path).agg(F.min("tag"), F.count("*")).first() == ("a", 100)
    sinks.write_splits(_table(spark, "c", 10), path)
    assert sinks.read_splits(spark, path).agg(F.min("tag"), F.count("*")).first() == ("c", 10)


def test_racing_writers_and_vacuum(spark, path):
    for tag in "abc":
        sinks.write_version(_table(spark, tag, 10), path, "split")
    known = sinks.versions(spark, path)
    assert [n for n, _ in known] == [1, 2, 3]
    # a writer that raced for number 3: both stand, one is read
    racer = "f" * 32
    _table(spark, "z", 5).write.partitionBy("split").parquet(f"{path}/{racer}")
    open(f"{_local(path)}/{sinks.MARKS}/{3:012d}-{racer}", "w").close()
    assert sinks.read_splits(spark, path).count() in (5, 10)
    os.makedirs(f"{_local(path)}/stale")
    os.utime(f"{_local(path)}/stale", (1, 1))
    os.makedirs(f"{_local(path)}/fresh")
    gone = sinks.vacuum(spark, path, keep=2)
    assert sorted(gone) == sorted([known[0][1], known[1][1], "stale"])
    assert len(sinks.versions(spark, path)) == 2 and os.path.isdir(f"{_local(path)}/fresh")
    assert sinks.read_version(spark, path, known[2][1]).count() == 10
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, path, known[0][1])


def test_no_version_yet(spark, path):
    assert sinks.versions(spark, path) == [] and sinks.vacuum(spark, path) == []
    with pytest.raises(FileNotFoundError):
        sinks.read_splits(spark, path)
