"""Progress of a stream, one row for each batch and source partition, kept over restarts.

A listener writes what Spark reports after a batch as one small file of JSON lines named by
the batch, so a batch that is reported twice has its rows once. Batches that read nothing
leave no rows.
"""

from __future__ import annotations

import json
from collections import deque
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wakeline.sources import storage

PROGRESS = (
    "query STRING, run_id STRING, batch_id BIGINT, at TIMESTAMP, source INT, "
    "source_partition STRING, start_offset BIGINT, end_offset BIGINT, "
    "batch_rows BIGINT, arrived_per_s DOUBLE, processed_per_s DOUBLE"
)


def flat_offsets(offset: str | None) -> dict[str, int]:
    """Whole numbers of an offset in JSON, by the names that lead to them.

    A topic's partitions become ``topic/0``, a file of growing lines ``bytes/<path>``; an
    offset that is a number alone has an empty name. Before its first batch a source has
    no offset, which Spark tells as ``None`` or ``null``.
    """

    def walk(name: str, value) -> dict[str, int]:
        if isinstance(value, dict):
            return {k: v for key, x in value.items() for k, v in walk(f"{name}/{key}" if name else key, x).items()}
        return {} if isinstance(value, bool) or not isinstance(value, int) else {name: value}

    return {} if offset in (None, "", "None", "null") else walk("", json.loads(offset))


def progress_rows(progress) -> list[dict]:
    """One row for each source partition that a batch read from."""
    rows = []
    for place, source in enumerate(progress.sources):
        first, last = flat_offsets(source.startOffset), flat_offsets(source.endOffset)
        rows += [
            {
                "query": progress.name,
                "run_id": str(progress.runId),
                "batch_id": progress.batchId,
                "at": progress.timestamp,
                "source": place,
                "source_partition": name,
                "start_offset": first.get(name),
                "end_offset": end,
                "batch_rows": source.numInputRows,
                "arrived_per_s": _number(source.inputRowsPerSecond),
                "processed_per_s": _number(source.processedRowsPerSecond),
            }
            for name, end in last.items()
            if first.get(name) != end
        ]
    return rows


def _number(value: float) -> float | None:
    return value if value == value and abs(value) != float("inf") else None


_WAITING = 100
_logs: WeakKeyDictionary[SparkSession, ProgressLog] = WeakKeyDictionary()


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of the runs it follows, each below a folder of its own.

    A run is known by its id only once it has started, so what is reported of other runs
    meanwhile is held back, the last few reports of it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: dict[str, str] = {}
        self.waiting: deque = deque(maxlen=_WAITING)
        self.lock = Lock()

    def follow(self, run_id, root: str) -> None:
        with self.lock:
            self.folders[str(run_id)] = f"{root.rstrip('/')}/progress"
            early = [progress for progress in self.waiting if str(progress.runId) == str(run_id)]
        for progress in early:
            self._keep(progress)

    def _keep(self, progress) -> None:
        rows = progress_rows(progress)
        if rows:
            path = f"{self.folders[str(progress.runId)]}/batch_id={progress.batchId}"
            storage.write_line(self.spark, path, "\n".join(map(json.dumps, rows)) + "\n", overwrite=True)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            known = str(event.progress.runId) in self.folders
            if not known:
                self.waiting.append(event.progress)
        if known:
            self._keep(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_log(spark: SparkSession) -> ProgressLog:
    """The session's listener, added when it is first asked for."""
    if spark not in _logs:
        _logs[spark] = ProgressLog(spark)
        spark.streams.addListener(_logs[spark])
    return _logs[spark]


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """All rows kept so far."""
    folder = f"{root.rstrip('/')}/progress"
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).json(folder)


def offset_report(progress: DataFrame) -> DataFrame:
    """Per source partition: how far it was read, in how many batches and runs, and whether
    every batch began where the one before ended. The first offset is NULL where the
    source began without one.

    A partition has one row per batch here, and only its own are ordered.
    """
    along = Window.partitionBy("query", "source", "source_partition").orderBy("batch_id")
    before = F.lag("end_offset").over(along)
    steps = progress.withColumns(
        {
            "_rewound": F.coalesce(F.col("start_offset") < before, F.lit(False)),
            "_skipped": F.coalesce(F.col("start_offset") > before, F.lit(False)),
        }
    )
    return steps.groupBy("query", "source", "source_partition").agg(
        F.min_by("start_offset", "batch_id").alias("first_offset"),
        F.max("end_offset").alias("last_offset"),
        F.count(F.lit(1)).alias("batches"),
        F.count_distinct("run_id").alias("runs"),
        F.count_if("_rewound").alias("rewound"),
        F.count_if("_skipped").alias("skipped"),
    )


def rate_report(progress: DataFrame) -> DataFrame:
    """Per batch: rows read, and rows per second as they arrived and as they were processed."""
    per_source = progress.groupBy("query", "batch_id", "source").agg(
        F.max("at").alias("at"),
        F.max("batch_rows").alias("rows"),
        F.max("arrived_per_s").alias("arrived_per_s"),
        F.max("processed_per_s").alias("processed_per_s"),
    )
    return per_source.groupBy("query", "batch_id").agg(
        F.max("at").alias("at"),
        F.sum("rows").alias("rows"),
        F.sum("arrived_per_s").alias("arrived_per_s"),
        F.sum("processed_per_s").alias("processed_per_s"),
    )
