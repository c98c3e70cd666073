"""Counting reports over feeds and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.rules import DUPLICATE, TOO_LATE, blank


def kind_of(patterns: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """Label of the first LIKE pattern the event id matches."""
    kind = F.lit(default)
    for pattern, label in reversed(patterns):
        kind = F.when(F.col("event_id").like(pattern), label).otherwise(kind)
    return kind


def kind_report(detail: DataFrame, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    return (
        detail.groupBy(kind_of(patterns).alias("kind"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.count_if("overheat").alias("overheat_true"),
            F.count_if("late").alias("late_true"),
        )
        .orderBy("kind")
    )


def reason_report(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("cnt")).orderBy("reason")


def of_run(rejected: DataFrame, id_prefix: str, aircraft_id: str) -> DataFrame:
    """Rejected rows of one run: its ids, and its aircraft's rows without an id."""
    own_id = F.coalesce(F.col("event_id").startswith(id_prefix), F.lit(False))
    return rejected.where(own_id | ((F.col("aircraft_id") == aircraft_id) & blank("event_id")))


def lookup(rows: DataFrame, flight_id: str, id_prefixes: Sequence[str]) -> DataFrame:
    """Rows of a flight, and rows of any flight whose id starts with a prefix."""
    wanted = F.col("flight_id") == flight_id
    for prefix in id_prefixes:
        wanted = wanted | F.col("event_id").like(f"{prefix}%")
    return rows.where(wanted)


def flight_counts(detail: DataFrame) -> DataFrame:
    return detail.groupBy("flight_id").agg(F.count(F.lit(1)).alias("cnt"))


def latest(rows: DataFrame, *newest_first: str, tie_break: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` newest rows; ``tie_break`` makes the choice unique."""
    order = [F.desc_nulls_last(name) for name in newest_first]
    return rows.orderBy(*order, *tie_break).limit(k)


def stage_measures() -> list[Column]:
    """What each stage did, as aggregates of rows with their final ``reason``."""
    reason, late = F.col("reason"), F.col("late")
    behind = F.coalesce(reason.contains(TOO_LATE), F.lit(False))
    return [
        F.count(F.lit(1)).alias("decoded"),
        F.count_if(behind).alias("late_dropped"),
        F.count_if(late & ~behind).alias("late_accepted"),
        F.count_if(reason == DUPLICATE).alias("dedup_dropped"),
        F.count_if(reason.isNotNull() & ~reason.contains(TOO_LATE) & (reason != DUPLICATE)).alias(
            "defect_dropped"
        ),
        F.count_if(reason.isNull() & F.col("overheat")).alias("overheat_kept"),
        F.count_if(reason.isNull()).alias("written"),
    ]


def stage_counters(marked: DataFrame) -> DataFrame:
    """What each stage did, in one pass over marked rows."""
    return marked.agg(*stage_measures())


def feed_counters(sent: DataFrame) -> DataFrame:
    """Per aircraft, how many messages were sent and with which anomaly."""
    anomaly = F.coalesce("anomaly", F.lit("normal"))
    shifted = anomaly.startswith("late") | anomaly.startswith("out_of") | anomaly.startswith("too_")
    return sent.groupBy("aircraft_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(anomaly.isin("normal", "overheat")).alias("normal"),
        F.count_if(shifted).alias("late"),
        F.count_if(anomaly == "duplicate").alias("duplicate"),
        F.count_if(anomaly.endswith("overheat")).alias("overheat"),
    )


def throughput(rows: DataFrame, at: str = "proc_time") -> DataFrame:
    """Rows, seconds between first and last arrival, and rows per second."""
    elapsed = (F.unix_millis(F.max(at)) - F.unix_millis(F.min(at))) / 1000.0
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), elapsed.alias("elapsed_s"))
    return totals.withColumn("rows_per_s", F.try_divide(F.col("rows"), F.col("elapsed_s")))
