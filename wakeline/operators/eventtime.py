"""Watermarks over arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.running import BUCKET_ROWS, running
from wakeline.settings import Rules, seconds


def with_watermark_column(
    df: DataFrame,
    order: str = "arrival_seq",
    rules: Rules = Rules(),
    width: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``watermark``: newest event time up to and including the row, less the bound.

    Every row moves it, also one that is rejected later, so call this before
    any filter.
    """
    seen = running(df, order, {"_newest": ("max", F.col("event_time"))}, width=width)
    return seen.withColumn(
        "watermark", F.col("_newest") - seconds(rules.out_of_order_s)
    ).drop("_newest")


def final_watermark(df: DataFrame, rules: Rules = Rules()) -> Column:
    """The watermark after the last row, as a scalar subquery."""
    newest = df.agg(F.max("event_time").alias("newest"))
    return newest.select(F.col("newest") - seconds(rules.out_of_order_s)).scalar()
