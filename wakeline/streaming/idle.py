"""Telling that a source partition has gone silent, while no message arrives.

Spark runs a batch for new data, so by data alone nothing says that a partition is idle. A
timer in processing time does: it is set anew by every batch that brings something of the
partition, and when it expires, the stream gets one row that releases the partition. The
state is one time per partition; readings are reduced to that before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wakeline.settings import Rules

# True in rows that release a partition: silent since ``kafka_timestamp``.
RELEASED = "released"
_NEWEST = "kafka_partition int, arrived long"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest arrival of each partition, one row per Arrow batch and partition."""
    for batch in batches:
        if batch.num_rows:
            found = pa.table(batch).group_by("kafka_partition").aggregate([("arrived", "max")])
            for piece in found.select(["kafka_partition", "arrived_max"]).to_batches():
                yield pa.RecordBatch.from_arrays(piece.columns, ["kafka_partition", "arrived"])


class _IdleTimer(StatefulProcessor):
    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrived = handle.getValueState("arrived", "at_us long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known = [row.arrived for row in rows if row.arrived is not None]
        if self.arrived.exists():
            known.append(self.arrived.get()[0])
        self.arrived.update((max(known, default=0),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        yield Row(kafka_partition=key[0], arrived=self.arrived.get()[0])


def with_releases(messages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``messages`` and, for each partition silent for the idle time, a row that releases it.

    Needs the RocksDB state store. Every trigger then runs a batch, with data or without.
    """
    newest = messages.select("kafka_partition", F.unix_micros("kafka_timestamp").alias("arrived"))
    released = (
        newest.mapInArrow(_newest, _NEWEST)
        .groupBy("kafka_partition")
        .transformWithState(
            _IdleTimer(int(rules.idle_s * 1000)),
            _NEWEST,
            "Append",
            "ProcessingTime",
        )
    )
    released = released.select(
        "kafka_partition", F.timestamp_micros("arrived").alias("kafka_timestamp"), F.lit(True).alias(RELEASED)
    )
    return messages.withColumn(RELEASED, F.lit(False)).unionByName(released, allowMissingColumns=True)
