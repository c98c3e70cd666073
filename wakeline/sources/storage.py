"""Folders on whatever file system a path names."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    system, where = _located(spark, path)
    system.delete(where, True)


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of the folders named ``key=<number>`` in ``path``, in order."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(where)]
    prefix = f"{key}="
    return sorted(int(name[len(prefix) :]) for name in names if name.startswith(prefix))


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job finished writing the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def write_line(spark: SparkSession, path: str, line: str, overwrite: bool) -> bool:
    """Write a file of one ASCII line; False if it exists and is not to be overwritten."""
    system, where = _located(spark, path)
    try:
        out = system.create(where, overwrite)
    except Py4JJavaError:
        if overwrite or not system.exists(where):
            raise
        return False
    try:
        out.writeBytes(line)
    finally:
        out.close()
    return True


def read_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file; None if there is no such file, or no line yet."""
    system, where = _located(spark, path)
    if not system.exists(where):
        return None
    file = system.open(where)
    try:
        return file.readLine()
    finally:
        file.close()


def age_s(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    system, where = _located(spark, path)
    return time.time() - system.getFileStatus(where).getModificationTime() / 1000
