"""Minute aggregate on Spark's own event-time state, without the quality tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import rules as R
from wakeline.operators.minutes import MEASURES
from wakeline.settings import Rules

_AGG = {"avg": F.avg, "max": F.max, "min": F.min}


def minute_agg_stream(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Closed minutes of valid rows, for append mode.

    One watermark for the whole stream; copies are not removed and late rows not
    counted apart. A minute is emitted, and takes rows, until the batch after the
    one that moved the watermark past its end. Invalid rows take part in the grouping without being counted:
    a filter in front would be pushed below the watermark and hide their time.
    """
    valid = R.reject_reason(F.lit(None).cast("timestamp"), rules).isNull()
    grouped = (
        rows.withColumn("_valid", valid)
        .withWatermark("event_time", f"{rules.out_of_order_s} seconds")
        .groupBy(F.window("event_time", rules.minute), "aircraft_id", "flight_id")
        .agg(
            F.count_if("_valid").alias("event_count"),
            *[
                _AGG[kind](F.when(F.col("_valid"), F.col(sensor))).alias(name)
                for name, (kind, sensor) in MEASURES.items()
            ],
        )
    )
    return grouped.where(F.col("event_count") > 0).select(
        "aircraft_id",
        "flight_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "event_count",
        *MEASURES,
    )
