"""First copy of every id within a bounded memory.

A copy is accepted when no copy of its id was accepted less than the memory before
it; the memory runs from the accepted copy and later copies do not renew it. Copies
count in the order of their time, then position.

There is one path for any number of copies. Copies of one moment are one, so what is
left of an id within one memory is bounded by the moments in it, however often the id
was sent. Time is cut into spans as long as the memory: a span holds at most one
accepted copy, and the first copy after an empty span is always accepted. Between
those, every copy knows the copy that would be accepted next, and doubling these jumps
walks all ids at once in a number of joins that is the logarithm of the longest walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.settings import Rules
from wakeline.sources.staging import staged


def _spans(moments: DataFrame) -> DataFrame:
    """Per id and span: its first copy, and whether spans right before and after exist.

    ``_after`` is the first copy of the next span but one. A window over an id has one
    row per memory of history.
    """
    along = Window.partitionBy("_id").orderBy("_span")
    first = F.min(F.struct("_in", "_seq"))["_seq"]
    beside = {
        "_head": F.coalesce(F.lag("_span").over(along) < F.col("_span") - 1, F.lit(True)),
        "_tail": F.coalesce(F.lead("_span").over(along) > F.col("_span") + 1, F.lit(True)),
        "_after": F.when(
            F.lead("_span", 2).over(along) == F.col("_span") + 2, F.lead("_first", 2).over(along)
        ),
    }
    return moments.groupBy("_id", "_span").agg(first.alias("_first")).withColumns(beside)


def _jumps(moments: DataFrame, spans: DataFrame) -> DataFrame:
    """For copies with a span beside theirs, the copy accepted next if they are.

    That is the first one at least as far into the next span; failing that, the first
    one of the span after.
    """
    linked = spans.where(~(F.col("_head") & F.col("_tail"))).select("_id", "_span", "_after")
    copies = moments.join(linked, ["_id", "_span"])
    both = copies.select(
        "_id",
        "_in",
        "_seq",
        "_after",
        F.explode(F.array(F.lit(False), F.lit(True))).alias("_asks"),
        "_span",
    ).withColumn("_meets", F.col("_span") + F.col("_asks").cast("int"))
    # From the end of the span back to its start, so one pass carries the answer.
    back = Window.partitionBy("_id", "_meets").orderBy(F.desc("_in"), "_asks")
    answer = F.last(F.when(~F.col("_asks"), F.col("_seq")), ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn("_next", F.coalesce(answer, "_after"))
        .where(F.col("_asks") & F.col("_next").isNotNull())
        .select("_seq", "_next")
    )


def _walk(heads: DataFrame, jumps: DataFrame) -> DataFrame:
    """All copies reached from ``heads`` by any number of jumps."""
    doubled = [staged(jumps, "dedup-jumps")]
    while not doubled[-1].isEmpty():
        once = doubled[-1]
        then = once.select(F.col("_seq").alias("_next"), F.col("_next").alias("_far"))
        twice = once.join(then, "_next").select("_seq", F.col("_far").alias("_next"))
        doubled.append(staged(twice, "dedup-jumps"))
    reached = heads
    for jump in reversed(doubled[:-1]):
        both = F.array_compact(F.array("_seq", "_next"))
        reached = reached.join(jump, "_seq", "left").select(F.explode(both).alias("_seq"))
    return reached


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time))


def accepted_positions(
    clean: DataFrame,
    id_col: str = "event_id",
    order: str = "arrival_seq",
    time: str = "proc_time",
    rules: Rules = Rules(),
) -> DataFrame:
    """Positions of the accepted copies, one column named like ``order``.

    ``order`` is unique over all ids and may be a struct; ``time`` is not NULL.
    """
    memory = F.lit(int(rules.dedup_ttl_s * 1_000_000)).cast("long")
    moments = staged(
        clean.groupBy(F.col(id_col).alias("_id"), _micros(time).alias("_at"))
        .agg(F.min(order).alias("_seq"))
        .withColumn("_in", F.pmod("_at", memory))
        .select("_id", "_seq", "_in", ((F.col("_at") - F.col("_in")) / memory).cast("long").alias("_span")),
        "dedup-moments",
    )
    spans = staged(_spans(moments), "dedup-spans")
    heads = spans.where("_head").select(F.col("_first").alias("_seq"))
    return _walk(heads, _jumps(moments, spans)).withColumnRenamed("_seq", order)


def mark_first(rows: DataFrame, accepted: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """Add ``is_first``: whether the row is an accepted copy."""
    flag = accepted.withColumn("is_first", F.lit(True))
    return rows.join(flag, order, "left").withColumn(
        "is_first", F.coalesce("is_first", F.lit(False))
    )
