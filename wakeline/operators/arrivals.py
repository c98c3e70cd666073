"""Watermark over several source partitions, some of them slow or idle.

Arrival time is cut into short slices. A row sees the newest event time of its own
partition up to itself, and of every other active partition up to the slice before its
own; the slowest of them sets its watermark, which never falls. So a row's watermark
follows from what arrived before it, not from how rows were put into batches, as long
as batches follow arrival time. With one partition it is the exact running maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.operators.running import running
from wakeline.settings import Rules, seconds

SOURCES = T.StructType(
    [
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("slice", T.LongType()),
        T.StructField("newest", T.TimestampType()),
    ]
)


def _slice_of(rules: Rules) -> Column:
    return F.floor(F.unix_millis("proc_time") / F.lit(rules.slice_ms)).alias("slice")


def _idle_slices(rules: Rules) -> int:
    return max(1, int(rules.idle_s * 1000) // rules.slice_ms)


def _by_slice(rows: DataFrame, earlier: DataFrame | None, rules: Rules) -> DataFrame:
    """Newest event time per partition and slice, those of earlier batches included."""
    now = rows.groupBy("kafka_partition", _slice_of(rules)).agg(F.max("event_time").alias("newest"))
    return now if earlier is None else now.unionByName(earlier.select(*now.columns))


def seen_sources(rows: DataFrame, earlier: DataFrame | None, rules: Rules = Rules()) -> DataFrame:
    """State for the next batch: per partition, its last slices before and in the newest slice.

    At most two rows per partition.
    """
    seen = _by_slice(rows, earlier, rules)
    # Taken as a number: rows numbered by Spark cannot be grouped by a subquery over them.
    last = F.col("slice") == F.lit(seen.agg(F.max("slice")).first()[0]).cast("long")
    return (
        seen.groupBy("kafka_partition", last.alias("last"))
        .agg(F.max("slice").alias("slice"), F.max("newest").alias("newest"))
        .select(*SOURCES.fieldNames())
    )


def _slowest(rows: DataFrame, earlier: DataFrame | None, rules: Rules) -> DataFrame:
    """Per slice, the two slowest active partitions before it, and the watermark so far.

    A partition's state is repeated for the slices until its next rows, at most for the
    idle time, so the table has one row per slice and active partition.
    """
    along = Window.partitionBy("kafka_partition").orderBy("slice")
    last = F.col("slice") + _idle_slices(rules) - 1
    seen = (
        _by_slice(rows, earlier, rules)
        .groupBy("kafka_partition", "slice")
        .agg(F.max("newest").alias("newest"))
        .withColumn("until", F.least(F.lead("slice").over(along), last))
        .withColumn("newest", F.max("newest").over(along))
        .select(F.struct("newest", "kafka_partition").alias("source"), "slice", "until")
    )
    valid = F.when(F.col("until") > F.col("slice"), F.sequence(F.col("slice") + 1, F.col("until")))
    active = seen.select("source", F.explode(valid).alias("slice"))
    own = seen.select(F.lit(None).cast(seen.schema["source"].dataType).alias("source"), "slice")
    slow = F.slice(F.sort_array(F.collect_list("source")), 1, 2)
    per_slice = (
        active.unionByName(own)
        .groupBy("slice")
        .agg(slow.alias("slow"))
        .withColumns({"slow1": F.get("slow", F.lit(0)), "slow2": F.get("slow", F.lit(1))})
        .drop("slow")
    )
    # A partition that has sent no event time yet comes first, as NULL, and holds.
    return running(per_slice, "slice", {"so_far": ("max", F.col("slow1")["newest"])})


def with_arrival_watermark(
    rows: DataFrame, earlier: DataFrame | None, floor: Column, rules: Rules = Rules()
) -> DataFrame:
    """Add ``watermark`` of each row and ``settled``, below which no later row's can fall.

    ``rows`` have ``proc_time`` and unique offsets per partition; ``earlier`` is the
    state of :func:`seen_sources`, ``floor`` the watermark earlier batches reached.
    """
    own = running(
        rows.withColumn("slice", _slice_of(rules)),
        "kafka_offset",
        {"own": ("max", F.col("event_time"))},
        keys=["kafka_partition"],
    )
    if earlier is not None:
        # Two rows per source partition, whatever the batch holds.
        before = earlier.groupBy("kafka_partition").agg(F.max("newest").alias("before"))
        own = own.join(F.broadcast(before), "kafka_partition", "left").withColumn(
            "own", F.greatest("own", "before")
        ).drop("before")
    met = own.join(_slowest(rows, earlier, rules), "slice", "left")
    mine = F.coalesce(F.col("slow1")["kafka_partition"] == F.col("kafka_partition"), F.lit(False))
    other = F.when(mine, F.col("slow2")).otherwise(F.col("slow1"))
    newest = F.when(other.isNull(), F.col("own")).when(
        F.col("own").isNotNull() & other["newest"].isNotNull(),
        F.least("own", other["newest"]),
    )
    bound = seconds(rules.out_of_order_s)
    marks = {
        "watermark": F.greatest(F.greatest("so_far", newest) - bound, floor),
        "settled": F.greatest(F.col("so_far") - bound, floor),
    }
    return met.withColumns(marks).drop("slice", "own", "slow1", "slow2", "so_far")


def reached_watermark(
    sources: DataFrame, settled_ms: int | None, rules: Rules = Rules()
) -> int | None:
    """The watermark after a batch in epoch ms, from its state and ``settled``.

    Where a single partition is active, its newest row counts at once.
    """
    newest_slice = F.max("slice").over(Window.partitionBy())
    active = (
        sources.groupBy("kafka_partition")
        .agg(F.max("slice").alias("slice"), F.max("newest").alias("newest"))
        .withColumn("last", newest_slice)
        .where(F.col("slice") > F.col("last") - _idle_slices(rules))
        .agg(F.count(F.lit(1)).alias("sources"), F.unix_millis(F.max("newest")).alias("newest_ms"))
        .first()
    )
    found = [settled_ms]
    if active["sources"] == 1 and active["newest_ms"] is not None:
        found.append(active["newest_ms"] - int(rules.out_of_order_s * 1000))
    return max((ms for ms in found if ms is not None), default=None)


def released_watermark(
    sources: DataFrame, idle: list[int], reached_ms: int | None, rules: Rules = Rules()
) -> int | None:
    """The watermark in epoch ms while the partitions named are idle.

    The slowest partition that is left sets it, and the one heard of last where none is
    left: it was alone before it fell silent too. It never falls below ``reached_ms``.
    ``sources`` is the state of :func:`seen_sources`, a row or two per partition.
    """
    ends = sources.groupBy("kafka_partition").agg(
        F.max("slice").alias("slice"), F.max("newest").alias("newest")
    )
    active = ~F.col("kafka_partition").isin(idle)
    found = ends.agg(
        F.unix_millis(F.min(F.when(active, F.col("newest")))).alias("slowest_ms"),
        F.count_if(active & F.col("newest").isNull()).alias("holding"),
        F.count_if(active).alias("active"),
        F.unix_millis(F.max(F.struct("slice", "newest"))["newest"]).alias("last_ms"),
    ).first()
    if found["holding"]:
        return reached_ms
    newest = found["slowest_ms"] if found["active"] else found["last_ms"]
    known = [reached_ms, None if newest is None else newest - int(rules.out_of_order_s * 1000)]
    return max((ms for ms in known if ms is not None), default=None)
