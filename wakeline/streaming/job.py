"""The streaming job: one micro-batch query writing three tables.

Every batch writes under ``batch_id=<id>`` and counts only once its commit is
written, so a batch that failed half-way is repeated over its own remains. A commit
keeps a fingerprint of its messages: a batch that comes again with others, as after
the loss of a checkpoint, is an error, and no committed batch is overwritten.

Rows are judged in arrival order, inside a batch as well, so the tables do not depend
on how messages fall into batches. A message arrives when the topic took it; messages
without that time arrive with their batch.

Layout below the job's folder::

    detail, rejected, minutes      results, one folder per batch
    state/accepted                 ids accepted by the batch, and by batches merged into it
    state/sources                  newest event time per partition
    state/open_minutes             parts of minutes not closed yet
    begun, commits                 time of the batch; watermark after it
    owner                          the driver at work there
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wakeline.functions import rules as R
from wakeline.operators.arrivals import (
    SOURCES,
    reached_watermark,
    released_watermark,
    seen_sources,
    with_arrival_watermark,
)
from wakeline.operators.dedup import accepted_positions
from wakeline.operators.minutes import (
    counted,
    finish_partials,
    merge_partials,
    partial_minutes,
)
from wakeline.operators.reports import stage_measures
from wakeline.plans.replay import detail_columns, rejected_columns
from wakeline.schema import DETAIL
from wakeline.settings import Rules, seconds
from wakeline.sources import storage
from wakeline.sources.staging import dropped_after
from wakeline.sources.wire import parse
from wakeline.streaming.idle import RELEASED, with_releases
from wakeline.streaming.progress import progress_log

ACCEPTED = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("accepted_at", T.TimestampType()),
        T.StructField("by_batch", T.LongType()),
    ]
)
# Times of the job itself are epoch milliseconds, which no session zone touches.
# ``sources_of`` and ``minutes_of`` name the batches whose state is the current one: a batch
# without messages leaves it where it is. ``idle`` lists the partitions released and not
# heard of since.
# ``recent`` lists the folders of accepted ids still remembered. Two of one level are
# merged into the next batch's, so their number is the logarithm of that of the batches.
COMMIT = (
    "watermark_ms BIGINT, recent ARRAY<STRUCT<batch_id: BIGINT, at_ms: BIGINT, level: INT>>, "
    "idle ARRAY<INT>, sources_of BIGINT, minutes_of BIGINT, fingerprint BIGINT, "
    "ingested BIGINT, parse_failed BIGINT, decoded BIGINT, late_dropped BIGINT, "
    "late_accepted BIGINT, dedup_dropped BIGINT, defect_dropped BIGINT, "
    "overheat_kept BIGINT, written BIGINT"
)
POSITION = ["kafka_partition", "kafka_offset"]
# Counters of a batch, in the commit.
STAGES = (
    "decoded",
    "late_dropped",
    "late_accepted",
    "dedup_dropped",
    "defect_dropped",
    "overheat_kept",
    "written",
)


def now_ms() -> int:
    return time.time_ns() // 1_000_000


def _moment(ms: int | None) -> Column:
    return F.timestamp_millis(F.lit(ms).cast("long"))


class QualityJob:
    """Processes micro-batches of raw messages into the tables below ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: Rules = Rules(),
        clock: Callable[[], int] = now_ms,
        owner: str | None = None,
        lease_s: float = 600,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rules = rules
        self.clock = clock
        self.owner = owner or spark.sparkContext.applicationId
        self.lease_s = lease_s

    def _claim(self, take_over: bool) -> None:
        """Own the job's folder, or fail: its marker names the driver that works there.

        Every batch renews the marker. One that is older than the lease belongs to a
        driver that died, or is idle and will fail at its next batch; a start takes it over.
        """
        marker = f"{self.root}/owner"
        if storage.write_line(self.spark, marker, self.owner, overwrite=False):
            return
        held = storage.read_line(self.spark, marker)
        expired = take_over and storage.age_s(self.spark, marker) >= self.lease_s
        if held != self.owner and not expired:
            raise RuntimeError(f"{self.root} is owned by {held}")
        storage.write_line(self.spark, marker, self.owner, overwrite=True)

    def _release(self) -> None:
        marker = f"{self.root}/owner"
        if storage.read_line(self.spark, marker) == self.owner:
            storage.delete(self.spark, marker)

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(
            self._path(table, batch_id)
        )

    def _read(self, table: str, schema, *batch_ids: int) -> DataFrame:
        paths = [self._path(table, batch_id) for batch_id in batch_ids]
        return self.spark.read.schema(schema).parquet(*paths)

    def _one_row(self) -> DataFrame:
        return self.spark.range(0, 1, 1, 1)

    def _begin(self, batch_id: int) -> int:
        """The batch's time; a repeated batch keeps the time of its first try."""
        path = self._path("begun", batch_id)
        storage.write_line(self.spark, path, f"{self.clock()}.", overwrite=False)
        line = storage.read_line(self.spark, path) or ""
        if not line.endswith("."):
            # A line that was not finished was never used.
            line = f"{self.clock()}."
            storage.write_line(self.spark, path, line, overwrite=True)
        return int(line[:-1])

    def commit_of(self, batch_id: int):
        if batch_id < 0 or not storage.complete(self.spark, self._path("commits", batch_id)):
            return None
        return self._read("commits", COMMIT, batch_id).first()

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """One micro-batch; call it again with the same id and messages and nothing changes."""
        self._claim(take_over=False)
        if RELEASED not in messages.columns:
            return self._process_once(messages, None, batch_id)
        # Computed once: what is behind the releases keeps state of its own.
        rows = messages.persist()
        try:
            released = rows.where(RELEASED)
            self._process_once(rows.where(~F.col(RELEASED)).drop(RELEASED), released, batch_id)
        finally:
            rows.unpersist()

    def _process_once(self, messages: DataFrame, released: DataFrame | None, batch_id: int) -> None:
        done = self.commit_of(batch_id)
        if done:
            print_of = self._positioned(messages, 0).agg(self._fingerprint()).first()[0]
            if print_of != done["fingerprint"]:
                raise RuntimeError(
                    f"batch {batch_id} was committed in {self.root} with other messages; "
                    "the checkpoint there is not the one that made it"
                )
            return
        before = self.commit_of(batch_id - 1)
        if before is None:
            self._refuse_other_batches(batch_id)
        with dropped_after(self.spark):
            self._process(messages, released, batch_id, before)

    def _refuse_other_batches(self, batch_id: int) -> None:
        """Without a commit right before it, a batch must be the first of an empty job."""
        for other in storage.numbered(self.spark, f"{self.root}/commits", "batch_id"):
            if self.commit_of(other):
                raise RuntimeError(
                    f"{self.root} holds batch {other}: batch {batch_id} does not follow it"
                )
        if batch_id > 0:
            raise RuntimeError(f"batch {batch_id - 1} was never committed in {self.root}")

    def _process(self, messages: DataFrame, released: DataFrame | None, batch_id: int, before) -> None:
        at = self._begin(batch_id)
        watermark = before["watermark_ms"] if before else None
        earlier = self._read("state/sources", SOURCES, before["sources_of"]) if before else None

        parsed = parse(self._positioned(messages, at)).persist()
        tagged = self._tagged(parsed.where("is_object"), earlier, watermark).persist()
        try:
            came = parsed.agg(
                F.count(F.lit(1)).alias("ingested"),
                self._fingerprint().alias("fingerprint"),
                F.unix_millis(F.min("proc_time")).alias("first_ms"),
                F.unix_millis(F.max("proc_time")).alias("last_ms"),
                F.collect_set("kafka_partition").alias("heard"),
            ).first()
            idle = self._idle(released, before, came["heard"])
            if before and not came["ingested"]:
                self._commit(batch_id, came, self._quiet(idle, before, batch_id))
                return
            recent = self._accept(tagged, before["recent"] if before else [], came, batch_id)
            mine = self._read("state/accepted", ACCEPTED, batch_id).where(
                F.col("by_batch") == batch_id
            )
            marked = self._marked(tagged, mine).persist()
            try:
                counters = self._write_results(marked, batch_id)
                settled = counters.pop("settled_ms")
                reached = self._advance(marked, earlier, watermark, settled, batch_id)
                reached = self._past_idle(idle, batch_id, reached)
                self._close_minutes(marked, reached, before, batch_id)
            finally:
                marked.unpersist()
        finally:
            tagged.unpersist()
            parsed.unpersist()
        state = {"watermark_ms": reached, "recent": recent, "idle": idle}
        self._commit(batch_id, came, {**state, "sources_of": batch_id, "minutes_of": batch_id, **counters})

    def _commit(self, batch_id: int, came, commit: dict) -> None:
        counted_rows = {
            "fingerprint": came["fingerprint"],
            "ingested": came["ingested"],
            "parse_failed": came["ingested"] - commit["decoded"],
        }
        text = F.lit(json.dumps({**commit, **counted_rows}))
        row = self._one_row().select(F.from_json(text, COMMIT).alias("c"))
        self._claim(take_over=False)
        self._write(row.select("c.*"), "commits", batch_id)

    def _idle(self, released: DataFrame | None, before, heard: list[int]) -> list[int]:
        """Partitions that are idle after this batch; a row or less of each comes here."""
        known = set(before["idle"]) if before else set()
        if released is not None:
            known |= {row[0] for row in released.select("kafka_partition").distinct().collect()}
        return sorted(known - set(heard))

    def _quiet(self, idle: list[int], before, batch_id: int) -> dict:
        """A batch without messages: partitions may go idle, and minutes close by that."""
        commit = {name: 0 for name in STAGES} | {
            name: before[name] for name in ("watermark_ms", "sources_of", "minutes_of")
        }
        commit |= {"recent": [past.asDict() for past in before["recent"]], "idle": idle}
        if idle == before["idle"]:
            return commit
        reached = self._past_idle(idle, before["sources_of"], before["watermark_ms"])
        if reached != before["watermark_ms"]:
            parts = self._read("state/open_minutes", self._parts_schema(), before["minutes_of"])
            self._split_minutes(parts, reached, batch_id)
            commit |= {"watermark_ms": reached, "minutes_of": batch_id}
        return commit

    def _past_idle(self, idle: list[int], sources_of: int, reached: int | None) -> int | None:
        """The watermark with the idle partitions no longer holding it back."""
        if not idle:
            return reached
        sources = self._read("state/sources", SOURCES, sources_of)
        return released_watermark(sources, idle, reached, self.rules)

    def _positioned(self, messages: DataFrame, at: int) -> DataFrame:
        print_of = F.pmod(F.xxhash64(*messages.columns), F.lit(1 << 31))
        rows = messages.withColumn("_print", print_of)
        if "kafka_offset" not in messages.columns:
            rows = rows.select(
                "*",
                F.lit(0).alias("kafka_partition"),
                F.monotonically_increasing_id().alias("kafka_offset"),
                _moment(at).alias("kafka_timestamp"),
            )
        return rows.withColumn("proc_time", F.coalesce("kafka_timestamp", _moment(at)))

    def _fingerprint(self) -> Column:
        """One number for the texts and positions of a batch, in any order."""
        return F.coalesce(F.sum("_print"), F.lit(0))

    def _tagged(
        self, rows: DataFrame, earlier: DataFrame | None, watermark: int | None
    ) -> DataFrame:
        seen = with_arrival_watermark(rows, earlier, _moment(watermark), self.rules)
        return R.tag(seen, F.col("watermark"), self.rules)

    def _accept(self, rows: DataFrame, recent: list, came, batch_id: int) -> list[dict]:
        """Write the copies to accept; returns the folders of ids remembered from now on.

        Copies of one moment are made one before ids are compared, so an id sent very
        often is no hot key.
        """
        memory_ms = int(self.rules.dedup_ttl_s * 1000)
        remembered = [
            past.asDict()
            for past in recent
            if came["first_ms"] is None or came["first_ms"] < past["at_ms"] + memory_ms
        ]
        fresh = (
            rows.where(F.col("reject_reason").isNull())
            .groupBy("event_id", "proc_time")
            .agg(F.min(F.struct(*POSITION)).alias("position"))
        )
        if remembered:
            known = self._read(
                "state/accepted", ACCEPTED, *[past["batch_id"] for past in remembered]
            )
            until = F.max("accepted_at") + seconds(self.rules.dedup_ttl_s)
            fresh = (
                fresh.join(known.groupBy("event_id").agg(until.alias("until")), "event_id", "left")
                .where(F.col("until").isNull() | (F.col("proc_time") >= F.col("until")))
                .drop("until")
            )
        chosen = accepted_positions(fresh, order="position", rules=self.rules)
        accepted = fresh.join(chosen, "position", "left_semi").select(
            "event_id",
            "position.*",
            F.col("proc_time").alias("accepted_at"),
            F.lit(batch_id).cast("long").alias("by_batch"),
        )
        newest, level = came["last_ms"], 0
        while remembered and remembered[-1]["level"] == level:
            past, level = remembered.pop(), level + 1
            accepted = accepted.unionByName(
                self._read("state/accepted", ACCEPTED, past["batch_id"])
            )
            newest = past["at_ms"] if newest is None else max(newest, past["at_ms"])
        if level and came["first_ms"] is not None:
            ended = _moment(came["first_ms"] - memory_ms)
            accepted = accepted.where(F.col("accepted_at") > ended)
        self._write(accepted, "state/accepted", batch_id)
        if newest is None:
            return remembered
        return [*remembered, {"batch_id": batch_id, "at_ms": newest, "level": level}]

    def _marked(self, rows: DataFrame, accepted: DataFrame) -> DataFrame:
        flag = accepted.select(*POSITION, F.lit(True).alias("is_first"))
        marked = rows.join(flag, POSITION, "left")
        later = F.when(F.col("is_first").isNull(), R.DUPLICATE)
        return marked.withColumn("reason", F.coalesce("reject_reason", later))

    def _write_results(self, marked: DataFrame, batch_id: int) -> dict:
        """Write both tables; what each stage did is counted on the rows as they pass."""
        kept = F.col("reason").isNull()
        settled = F.unix_millis(F.max("settled")).alias("settled_ms")
        counted_rows = []
        for table, rows, columns in (
            ("detail", marked.where(kept), detail_columns),
            ("rejected", marked.where(~kept), rejected_columns),
        ):
            seen = Observation()
            self._write(columns(rows.observe(seen, *stage_measures(), settled)), table, batch_id)
            counted_rows.append(seen.get)
        ends = [seen.pop("settled_ms") for seen in counted_rows]
        totals = {name: sum(seen[name] for seen in counted_rows) for name in counted_rows[0]}
        return {**totals, "settled_ms": max((ms for ms in ends if ms is not None), default=None)}

    def _advance(
        self,
        marked: DataFrame,
        earlier: DataFrame | None,
        watermark: int | None,
        settled: int | None,
        batch_id: int,
    ) -> int | None:
        self._write(seen_sources(marked, earlier, self.rules), "state/sources", batch_id)
        sources = self._read("state/sources", SOURCES, batch_id)
        known = [ms for ms in (settled, watermark) if ms is not None]
        return reached_watermark(sources, max(known, default=None), self.rules)

    def _close_minutes(self, marked: DataFrame, reached: int | None, before, batch_id: int) -> None:
        entered = marked.where(
            F.col("reason").isNull() & counted(F.col("watermark"), self.rules)
        )
        parts = partial_minutes(entered, self.rules)
        if before:
            parts = parts.unionByName(
                self._read("state/open_minutes", parts.schema, before["minutes_of"])
            )
        merged = merge_partials(parts).select(*parts.columns).persist()
        try:
            self._split_minutes(merged, reached, batch_id)
        finally:
            merged.unpersist()

    def _split_minutes(self, parts: DataFrame, reached: int | None, batch_id: int) -> None:
        closed = F.coalesce(F.col("window_end") <= _moment(reached), F.lit(False))
        self._write(finish_partials(parts.where(closed)), "minutes", batch_id)
        self._write(parts.where(~closed), "state/open_minutes", batch_id)

    def _parts_schema(self) -> T.StructType:
        rows = self.spark.createDataFrame([], T.StructType([*DETAIL.fields]))
        return partial_minutes(rows, self.rules).schema

    def start(
        self,
        stream: DataFrame,
        name: str = "telemetry-quality",
        every: str = "30 seconds",
        available_now: bool = False,
        release_idle: bool = False,
    ) -> StreamingQuery:
        """Start the query; a second one of the same name, or of another driver, is refused.

        Its checkpoint lives in the job's folder, so starting again resumes it. With
        ``release_idle`` every trigger runs a batch, and partitions silent for the idle
        time are released although no message arrives; the stream needs positions and the
        session the RocksDB state store. A job keeps or leaves that choice for good.
        """
        if any(query.name == name for query in self.spark.streams.active):
            raise RuntimeError(f"query {name!r} is already running")
        self._claim(take_over=True)
        progress = progress_log(self.spark)
        if release_idle:
            stream = with_releases(stream, self.rules)
        writer = (
            stream.writeStream.queryName(name)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .foreachBatch(self.process)
        )
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        query = writer.trigger(**trigger).start()
        progress.follow(query.runId, self.root)
        return query

    def run(
        self,
        open_stream: Callable[[], DataFrame],
        attempts: int = 30,
        delay_s: float = 15,
        **start_options,
    ) -> None:
        """Keep the query running: after a failure wait and resume, ``attempts`` times.

        Returns when the query ends by itself or is stopped.
        """
        for left in range(attempts, -1, -1):
            query = self.start(open_stream(), **start_options)
            try:
                query.awaitTermination()
                self._release()
                return
            except StreamingQueryException:
                if not left:
                    raise
                time.sleep(delay_s)
