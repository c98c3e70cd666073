"""Arrival order of landed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.staging import staged
from wakeline.sources.wire import decode

ARRIVAL_ORDER = ("proc_time", "kafka_partition", "kafka_offset")


def with_arrival_order(rows: DataFrame) -> DataFrame:
    """Number rows by arrival time, then position, in a new column ``arrival_seq``.

    The sort splits by sampled ranges of the whole, unique key, so a burst of
    equal arrival times is spread as well. The numbers have gaps, and they depend
    on where the ranges were cut, so the numbered rows are written out once.
    """
    ordered = rows.orderBy(*ARRIVAL_ORDER)
    return staged(
        ordered.withColumn("arrival_seq", F.monotonically_increasing_id()), "arrivals"
    )


def replay_feed(messages: DataFrame) -> DataFrame:
    """Feed for a batch replay of raw messages, arriving when the topic took them."""
    rows = decode(messages).withColumn("proc_time", F.col("kafka_timestamp"))
    return with_arrival_order(rows)
