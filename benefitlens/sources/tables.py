"""Readers for the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in (names or TABLES)}


def input_fingerprint(spark: SparkSession, sf_dir: str, tables=("customer", "orders", "nation", "region")) -> str:
    """Identity of a job's inputs: paths, sizes and modification times of the
    source files (file metadata only, no data is read)."""
    import hashlib
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    parts = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        for st in fs.listStatus(path) if fs.getFileStatus(path).isDirectory() else [fs.getFileStatus(path)]:
            parts.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)
