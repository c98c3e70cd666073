"""How rows spread over partitions, readers and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_by(rows: DataFrame, group: Column, name: str) -> DataFrame:
    """Rows, share of all rows and the busiest share, per value of ``group``.

    Meant for groups as few as partitions or readers: the totals are taken over
    the grouped rows. For keys use :func:`hottest_key`.
    """
    counts = rows.groupBy(group.alias(name)).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()
    total = F.sum("rows").over(everything)
    return counts.select(
        name,
        "rows",
        (F.col("rows") / total).alias("share"),
        (F.max("rows").over(everything) / total).alias("busiest_share"),
    )


def partition_share(rows: DataFrame) -> DataFrame:
    return share_by(rows, F.col("kafka_partition"), "kafka_partition")


def reader_share(rows: DataFrame, readers: int = 3) -> DataFrame:
    """Share per reader when reader i takes the partitions i, i + readers, …"""
    return share_by(rows, F.pmod("kafka_partition", F.lit(readers)), "subtask")


def hottest_key(rows: DataFrame, key: str = "aircraft_id") -> DataFrame:
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hottest = F.max(F.struct("n", key))
    return counts.agg(
        hottest[key].alias(key),
        hottest["n"].alias("rows"),
        F.sum("n").alias("total"),
        (hottest["n"] / F.sum("n")).alias("share"),
    )


def offset_progress(rows: DataFrame) -> DataFrame:
    """Offsets read per partition, and whether the range has no gap or repeat."""
    first, last = F.min("kafka_offset"), F.max("kafka_offset")
    return rows.groupBy("kafka_partition").agg(
        first.alias("first_offset"),
        last.alias("last_offset"),
        (last - first + 1).alias("delta"),
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) == last - first + 1).alias("complete"),
    )
