"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs once
after a warm-up query; ``stream_drain`` sends the whole feed as JSON through the
streaming job into its three tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.plans.catalog import QUERIES
from wakeline.plans.replay import Replay
from wakeline.sources.arrival import replay_feed
from wakeline.sources.feed import feed, wire_feed, with_offsets
from wakeline.sources.readers import recorded_stream, recorded_table
from wakeline.streaming.job import QualityJob
from wakeline.streaming.tables import read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "minute_agg",
    "detail_rows",
    "rejected_rows",
    "json_decode",
    "running_watermark",
    "lateness_class",
    "first_copy",
    "duplicate_copies",
    "dedup_ttl",
    "reason_report",
    "job_counters",
    "latest_rows",
    "reconcile_ids",
    "partition_skew",
    "hot_key",
    "offset_progress",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("wakeline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def record_topic(spark: SparkSession, folder: str) -> int:
    """Write the feed as a recorded topic; not part of any timing."""
    arrivals = feed(spark, SF_DIR)
    messages = wire_feed(with_offsets(arrivals, arrivals)).select(
        F.lit(None).cast("string").alias("key"),
        F.col("raw").alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        "arrival_seq",
    )
    ordered = messages.repartitionByRange(4, "arrival_seq").sortWithinPartitions("arrival_seq")
    ordered.drop("arrival_seq").write.json(folder)
    # A file stream reads in order of change times; give the parts their order.
    for place, part in enumerate(sorted(Path(folder).glob("part-*"))):
        os.utime(part, (1_700_000_000 + place,) * 2)
    return spark.read.text(folder).count()


def same_ids(spark: SparkSession, topic: str, root: str) -> bool:
    """Whether the stream accepted what the replay of the same messages accepts.

    Twelve partitions hold back each other's watermark, so only rows that lateness does
    not touch are compared: ids neither table calls late.
    """
    replay = Replay(replay_feed(recorded_table(spark, topic)))
    rejected = replay.rejected.where(F.col("reason").contains("too_late")).select("event_id")
    wanted = replay.detail.where(~F.col("late")).select("event_id").distinct()
    late = read_table(spark, root, "rejected").where(F.col("reason").contains("too_late")).select("event_id")
    found = read_table(spark, root, "detail").select("event_id").distinct()
    lost = wanted.join(found, "event_id", "left_anti").join(late, "event_id", "left_anti")
    extra = found.join(replay.detail.select("event_id"), "event_id", "left_anti").join(
        rejected, "event_id", "left_anti"
    )
    return lost.isEmpty() and extra.isEmpty()


def stream_drain(spark: SparkSession, topic: str, root: str) -> int:
    job = QualityJob(spark, root)
    query = job.start(recorded_stream(spark, topic), name="bench", available_now=True)
    query.awaitTermination()
    return read_table(spark, root, "detail").count()


def main() -> None:
    spark = session()
    drain(QUERIES["minute_agg"](spark, SF_DIR))
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        drain(QUERIES[name](spark, SF_DIR))
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    work = tempfile.mkdtemp(prefix="wakeline-bench-")
    sent = record_topic(spark, f"{work}/topic")
    started = time.perf_counter()
    kept = stream_drain(spark, f"{work}/topic", f"{work}/job")
    times["stream_drain"] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
                "stream_messages": sent,
                "stream_detail_rows": kept,
                "stream_agrees_with_replay": same_ids(spark, f"{work}/topic", f"{work}/job"),
                "stream_rows_per_s": round(sent / times["stream_drain"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
