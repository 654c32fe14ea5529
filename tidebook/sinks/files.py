"""Small file-system helpers that work on any storage Spark can reach."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def touch(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it already exists."""
    target, fs = _path(spark, path)
    if fs.exists(target):
        return False
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        # Another writer was first; anything else is a fault.
        if fs.exists(target):
            return False
        raise error
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, or an empty string when there is none."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return ""
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)
