"""Comparing ids between what was produced and what was stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.minutes import counted, minute_end
from wakeline.settings import Rules


def _copies(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias(name))


def reconcile_ids(produced: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: sizes of both sides, lost, foreign and repeated ids, and the verdict.

    Both sides are counted per id before they meet, so no id is hot in the join.
    """
    both = _copies(produced, "sent").join(_copies(stored, "kept"), "event_id", "full_outer")
    sent, kept = F.col("sent"), F.col("kept")
    totals = both.agg(
        F.count("sent").alias("produced"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("rows"),
        F.count("kept").alias("distinct_ids"),
        F.count_if(kept.isNull()).alias("missing"),
        F.count_if(sent.isNull()).alias("unexpected"),
    )
    repeated = F.col("rows") - F.col("distinct_ids")
    clean = (F.col("missing") == 0) & (F.col("unexpected") == 0) & (repeated == 0)
    return totals.withColumn("duplicate_rows", repeated).withColumn("ok", clean)


def lost_ids(produced: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids produced and not stored."""
    ids = produced.select("event_id").distinct()
    return ids.join(stored.select("event_id").distinct(), "event_id", "left_anti")


def _minute_counts(detail: DataFrame, minutes: DataFrame, rules: Rules) -> DataFrame:
    """Per id, the ids and the stored counts of the closed minutes it was counted in."""
    minute = ["aircraft_id", "flight_id", "window_end"]
    entered = detail.where(counted(F.col("watermark"), rules)).select(
        "event_id", "aircraft_id", "flight_id", minute_end(rules).alias("window_end")
    )
    ids = entered.groupBy(*minute).agg(F.count_distinct("event_id").alias("ids"))
    both = ids.join(minutes.select(*minute, "event_count"), minute)
    return (
        entered.join(both, minute)
        .groupBy("event_id")
        .agg(F.sum("ids").alias("minute_before"), F.sum("event_count").alias("minute_after"))
    )


def replay_check(
    detail: DataFrame, rejected: DataFrame, minutes: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """For every id with a rejected later copy, what the three tables hold of it.

    Its accepted and rejected copies; and of the closed minutes it was counted in, the
    different ids (``minute_before``, what they held without any copy) and the stored
    count (``minute_after``), 0 if there is no such minute. Replaying leaves both equal.
    """
    later = _copies(rejected.where(F.col("reason") == "duplicate"), "duplicate_rows")
    return (
        later.join(_copies(detail, "detail_rows"), "event_id", "left")
        .join(_minute_counts(detail, minutes, rules), "event_id", "left")
        .select(
            "event_id",
            F.coalesce("detail_rows", F.lit(0)).alias("detail_rows"),
            "duplicate_rows",
            F.coalesce("minute_before", F.lit(0)).alias("minute_before"),
            F.coalesce("minute_after", F.lit(0)).alias("minute_after"),
        )
    )
