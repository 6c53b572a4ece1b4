"""Folders of the shared storage, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if there is no such folder)."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders with all that is in them; one that is gone already is no error."""
    def gone(path: str) -> None:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(gone, paths))
