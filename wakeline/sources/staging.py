"""Intermediate results written once to the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from wakeline.sources import storage


# Folders staged by the work that will drop them, if there is such.
_OWNED: ContextVar[list[str] | None] = ContextVar("staged folders", default=None)


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged inside. Nothing staged may be read later."""
    paths: list[str] = []
    before = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(before)
        for path in paths:
            storage.delete(spark, path)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none, as in tests, gets a temporary folder; on a
    cluster that would be a folder of one machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wakeline-"))
    return context.getCheckpointDir()


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/wakeline/{spark.sparkContext.applicationId}"


def own_path(spark: SparkSession, name: str) -> str:
    """A new folder below this application's own, dropped with what it staged."""
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result steers the plan that follows it, or costs more to make
    again than to keep. The written table survives lost executors, and later
    reads prune its columns.
    """
    spark = df.sparkSession
    path = own_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged. Its plans cannot be run afterwards."""
    storage.delete(spark, _own_dir(spark))
