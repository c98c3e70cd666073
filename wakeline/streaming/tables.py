"""Reading a job's tables, merging their small files and removing old versions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.schema import DETAIL, MINUTE, REJECTED
from wakeline.sources import storage
from wakeline.streaming.job import COMMIT

TABLES = {"detail": DETAIL, "rejected": REJECTED, "minutes": MINUTE}


def _batch_schema(table: str) -> T.StructType:
    return T.StructType([*TABLES[table].fields, T.StructField("batch_id", T.LongType())])


def last_commit(spark: SparkSession, root: str) -> int:
    """Newest committed batch, -1 for none."""
    for batch_id in reversed(storage.numbered(spark, f"{root}/commits", "batch_id")):
        if storage.complete(spark, f"{root}/commits/batch_id={batch_id}"):
            return batch_id
    return -1


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """Watermark and counters of every committed batch that is still listed."""
    path = f"{root}/commits"
    schema = f"{COMMIT}, batch_id BIGINT"
    return spark.read.schema(schema).parquet(path).where(F.col("batch_id") <= last_commit(spark, root))


def _generations(spark: SparkSession, root: str, table: str) -> dict[int, dict]:
    """Finished generations of merged files, oldest first: up to which batch, made when.

    Each is told by a line of its own, which is written last; no Spark job reads it.
    """
    pointers = f"{root}/merged/{table}/pointers"
    found = {}
    for number in storage.numbered(spark, pointers, "generation"):
        line = storage.read_line(spark, f"{pointers}/generation={number}")
        if line and line.endswith("}"):
            found[number] = json.loads(line)
    return found


def _merged_to(generations: dict[int, dict], older_than_ms: int | None = None) -> int:
    """Newest batch the generations hold, of those made before ``older_than_ms``."""
    return max(
        (
            g["up_to"]
            for g in generations.values()
            if older_than_ms is None or g["made_ms"] < older_than_ms
        ),
        default=-1,
    )


def _batches(spark: SparkSession, root: str, table: str, after: int, to: int) -> DataFrame:
    rows = spark.read.schema(_batch_schema(table)).parquet(f"{root}/{table}")
    return rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= to)).select(
        *TABLES[table].fieldNames()
    )


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Committed rows of ``detail``, ``rejected`` or ``minutes``."""
    last, generations = last_commit(spark, root), _generations(spark, root, table)
    if not generations:
        if last < 0:
            return spark.createDataFrame([], TABLES[table])
        return _batches(spark, root, table, -1, last)
    merged = (
        spark.read.schema(TABLES[table])
        .parquet(f"{root}/merged/{table}/rows")
        .where(F.col("generation") <= max(generations))
        .select(*TABLES[table].fieldNames())
    )
    merged_to = _merged_to(generations)
    if last <= merged_to:
        return merged
    return merged.unionByName(_batches(spark, root, table, merged_to, last))


def merge_files(spark: SparkSession, root: str, table: str, now_ms: int) -> int | None:
    """Rewrite the batches committed since the last merge by aircraft.

    Only those batches are read, so merging costs what came in, not what is
    there. They stay until :func:`expire`; readers change over with the pointer,
    which is written last. Rebalancing splits a large aircraft over several files
    and joins small ones. The files keep ``aircraft_id`` itself, since a folder
    name cannot tell an empty one from NULL. Returns the new generation's number,
    None when nothing new was committed.
    """
    generations = _generations(spark, root, table)
    last, merged_to = last_commit(spark, root), _merged_to(generations)
    if last <= merged_to:
        return None
    number = max(generations, default=-1) + 1
    base = f"{root}/merged/{table}"
    (
        _batches(spark, root, table, merged_to, last)
        .withColumn("by_aircraft", F.col("aircraft_id"))
        .hint("rebalance", "by_aircraft")
        .write.mode("overwrite")
        .partitionBy("by_aircraft")
        .option("compression", "zstd")
        .parquet(f"{base}/rows/generation={number}")
    )
    pointer = json.dumps({"up_to": last, "made_ms": now_ms})
    storage.write_line(spark, f"{base}/pointers/generation={number}", pointer, overwrite=True)
    return number


def expire(spark: SparkSession, root: str, table: str, older_than_ms: int) -> int:
    """Delete the batches that merges made before ``older_than_ms`` have replaced.

    Returns the number of folders deleted.
    """
    merged_to = _merged_to(_generations(spark, root, table), older_than_ms)
    replaced = [
        batch_id
        for batch_id in storage.numbered(spark, f"{root}/{table}", "batch_id")
        if batch_id <= merged_to
    ]
    for batch_id in replaced:
        storage.delete(spark, f"{root}/{table}/batch_id={batch_id}")
    return len(replaced)


def expire_state(spark: SparkSession, root: str) -> int:
    """Delete state no later batch can ask for. Returns the number of folders deleted."""
    last = last_commit(spark, root)
    if last < 0:
        return 0
    path = f"{root}/commits/batch_id={last}"
    commit = spark.read.schema(COMMIT).parquet(path).first()
    remembered = {past["batch_id"] for past in commit["recent"]}
    keep = {
        "state/accepted": lambda batch_id: batch_id in remembered,
        "state/sources": lambda batch_id: batch_id == commit["sources_of"],
        "state/open_minutes": lambda batch_id: batch_id == commit["minutes_of"],
        "begun": lambda batch_id: False,
        "commits": lambda batch_id: False,
    }
    deleted = 0
    for table, kept in keep.items():
        for batch_id in storage.numbered(spark, f"{root}/{table}", "batch_id"):
            if batch_id < last and not kept(batch_id):
                storage.delete(spark, f"{root}/{table}/batch_id={batch_id}")
                deleted += 1
    return deleted
