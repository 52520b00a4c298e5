"""Folder operations through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def absolute(spark: SparkSession, path: str) -> str:
    """Path without scheme and host, made absolute by the file system it is on."""
    hadoop_path, fs = _path(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath()


def require_path(spark: SparkSession, path: str, what: str = "Bronbestand") -> None:
    """Raise ``FileNotFoundError`` for a path that is not there."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{what} niet gevonden: {path}")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder, sorted."""
    hadoop_path, fs = _path(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.rename(hadoop_path, _path(spark, target)[0])


def loadable(path: Column) -> Column:
    """A path as a reader takes it: characters that would make it a pattern are escaped."""
    return F.regexp_replace(path, r"([\\{}\[\]*?])", r"\\$1")
