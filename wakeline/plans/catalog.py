"""The queries this package offers over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import rules as R
from wakeline.functions.timetext import iso_ms, parse_iso
from wakeline.operators import balance, reconcile, reports
from wakeline.operators.eventtime import with_watermark_column
from wakeline.plans.lookups import Lookups, save_lookups
from wakeline.plans.replay import Replay, clean_records, rejected_columns
from wakeline.sources.feed import feed, wire_feed, with_offsets
from wakeline.sources.staging import own_path
from wakeline.sources.wire import PAYLOAD, decode, publish_records

Query = Callable[[SparkSession, str], DataFrame]

# Kinds of the feed's ids, for the kind report.
KINDS = (
    ("E-%33", "edge"),
    ("E-%13", "late"),
    ("E-%53", "late"),
    ("E-%73", "late"),
    ("E-%091", "replayed"),
    ("E-%1", "copied"),
)
FLIGHT = "AC-7-click"
PREFIXES = ("E-9", "E-47")


def _replay(spark: SparkSession, sf_dir: str) -> Replay:
    return Replay(feed(spark, sf_dir))


# Sources, decode and the three tables


def detail_rows(spark, sf_dir):
    return _replay(spark, sf_dir).detail


def rejected_rows(spark, sf_dir):
    replay = _replay(spark, sf_dir)
    rejected = replay.marked.where(F.col("reason").isNotNull())
    return rejected_columns(with_offsets(rejected, replay.feed))


def minute_agg(spark, sf_dir):
    rows = _replay(spark, sf_dir).minutes
    averages = [name for name in rows.columns if name.startswith("avg_")]
    return rows.withColumns({name: F.round(name, 6) for name in averages})


def clean_record(spark, sf_dir):
    return clean_records(_replay(spark, sf_dir).first)


def publish(spark, sf_dir):
    return publish_records(feed(spark, sf_dir))


def json_decode(spark, sf_dir):
    return decode(wire_feed(feed(spark, sf_dir))).select("arrival_seq", *PAYLOAD)


# Projection, predicates, scalars


def overheat_flag(spark, sf_dir):
    return feed(spark, sf_dir).select(
        "arrival_seq", "engine_temp_c", R.overheat().alias("overheat")
    )


def reject_reasons(spark, sf_dir):
    return _replay(spark, sf_dir).tagged.select("arrival_seq", "event_id", "reject_reason")


def clean_rows(spark, sf_dir):
    return _replay(spark, sf_dir).clean.select("arrival_seq", "event_id", "overheat", "late")


def rejected_lookup(spark, sf_dir):
    rows = reports.lookup(_replay(spark, sf_dir).rejected, FLIGHT, PREFIXES)
    return rows.select("event_id", "flight_id", "event_time", "ingest_time", "reason")


def stored_lookup(spark, sf_dir):
    """The same rows, from the rejected table as it is kept for look-ups."""
    path = own_path(spark, "lookups")
    save_lookups(_replay(spark, sf_dir).rejected, path, ["kafka_partition", "kafka_offset"])
    rows = Lookups(spark, path).run(FLIGHT, PREFIXES)
    return rows.select("event_id", "flight_id", "event_time", "ingest_time", "reason")


def iso_format(spark, sf_dir):
    text = feed(spark, sf_dir).select(
        "arrival_seq",
        iso_ms(F.col("event_time")).alias("event_text"),
        iso_ms(F.col("proc_time")).alias("proc_text"),
    )
    return text.withColumn("proc_time", parse_iso(F.col("proc_text")))


# Event time and windows


def running_watermark(spark, sf_dir):
    rows = with_watermark_column(feed(spark, sf_dir))
    return rows.select("arrival_seq", "event_time", "watermark")


def lateness_class(spark, sf_dir):
    rows = with_watermark_column(feed(spark, sf_dir))
    return rows.select(
        "arrival_seq", R.lateness_class(F.col("watermark")).alias("lateness")
    )


def post_close_rows(spark, sf_dir):
    rows = _replay(spark, sf_dir).post_close
    return rows.select("arrival_seq", "event_id", "event_time", "watermark", "late")


# Deduplication


def first_copy(spark, sf_dir):
    return _replay(spark, sf_dir).accepted.select("event_id", "arrival_seq", "proc_time")


def duplicate_copies(spark, sf_dir):
    return _replay(spark, sf_dir).repeated.select("event_id", "arrival_seq", "proc_time")


def dedup_ttl(spark, sf_dir):
    """Ids accepted more than once, because a copy came after the memory."""
    accepted = _replay(spark, sf_dir).accepted
    return (
        accepted.groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("accepted"),
            F.min("proc_time").alias("first_at"),
            F.max("proc_time").alias("last_at"),
        )
        .where(F.col("accepted") > 1)
    )


def too_late_replay(spark, sf_dir):
    """Later copies that are too late: rejected as such, not as duplicates."""
    rows = _replay(spark, sf_dir).marked
    return rows.where((F.col("copy") > 0) & F.col("reject_reason").contains(R.TOO_LATE)).select(
        "arrival_seq", "event_id", "reason"
    )


def replay_check(spark, sf_dir):
    replay = _replay(spark, sf_dir)
    return reconcile.replay_check(replay.first, replay.repeated, replay.minutes, replay.rules)


# Reports


def kind_report(spark, sf_dir):
    return reports.kind_report(_replay(spark, sf_dir).first, KINDS)


def reason_report(spark, sf_dir):
    return reports.reason_report(_replay(spark, sf_dir).decided.where("reason IS NOT NULL"))


def run_reasons(spark, sf_dir):
    """Reasons of one run: ids with its prefix, or its aircraft's rows without id."""
    run = reports.of_run(_replay(spark, sf_dir).rejected, "E-1", "AC-7")
    return reports.reason_report(run)


def flight_counts(spark, sf_dir):
    return reports.flight_counts(_replay(spark, sf_dir).first)


def job_counters(spark, sf_dir):
    """Counters of the whole job, from raw messages to stored rows."""
    raw = wire_feed(feed(spark, sf_dir))
    lines = raw.agg(F.count(F.lit(1))).scalar()
    # The flags written with the verdicts suffice: no row is read a second time.
    counters = reports.stage_counters(Replay(decode(raw)).decided)
    return counters.select(
        lines.alias("ingested"), (lines - F.col("decoded")).alias("parse_failed"), "*"
    )


def feed_counters(spark, sf_dir):
    """Per aircraft, what its arrivals were: copies, behind the newest reading, overheated."""
    rows = _replay(spark, sf_dir).tagged
    behind = F.nullif(R.lateness_class(F.col("watermark")), F.lit("on_time"))
    kind = F.when(F.col("copy") > 0, R.DUPLICATE).otherwise(behind)
    hot = F.when(F.col("overheat"), F.lit("overheat"))
    anomaly = F.nullif(F.concat_ws("+", kind, hot), F.lit(""))
    return reports.feed_counters(rows.withColumn("anomaly", anomaly))


def latest_rows(spark, sf_dir):
    rows = _replay(spark, sf_dir).detail
    return reports.latest(rows, "ingest_time", tie_break=["event_id"])


def latest_rejected(spark, sf_dir):
    rows = _replay(spark, sf_dir).rejected.select("event_id", "reason", "ingest_time")
    return reports.latest(rows, "ingest_time", tie_break=["event_id", "reason"])


def latest_minutes(spark, sf_dir):
    rows = _replay(spark, sf_dir).minutes.select(
        "aircraft_id", "flight_id", "window_start", "event_count", "late_count"
    )
    return reports.latest(rows, "window_start", tie_break=["aircraft_id", "flight_id"])


# Reconciliation and balance


def reconcile_ids(spark, sf_dir):
    replay = _replay(spark, sf_dir)
    produced = replay.feed.where((F.col("copy") == 0) & ~R.blank("event_id"))
    return reconcile.reconcile_ids(produced, replay.accepted)


def lost_ids(spark, sf_dir):
    replay = _replay(spark, sf_dir)
    produced = replay.feed.where((F.col("copy") == 0) & ~R.blank("event_id"))
    return reconcile.lost_ids(produced, replay.accepted)


def partition_skew(spark, sf_dir):
    return balance.partition_share(feed(spark, sf_dir))


def subtask_skew(spark, sf_dir):
    return balance.reader_share(feed(spark, sf_dir))


def hot_key(spark, sf_dir):
    return balance.hottest_key(feed(spark, sf_dir))


def offset_progress(spark, sf_dir):
    rows = feed(spark, sf_dir)
    return balance.offset_progress(with_offsets(rows, rows))


def throughput(spark, sf_dir):
    return reports.throughput(feed(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "minute_agg": minute_agg,
    "detail_rows": detail_rows,
    "rejected_rows": rejected_rows,
    "clean_record": clean_record,
    "publish_records": publish,
    "json_decode": json_decode,
    "overheat_flag": overheat_flag,
    "reject_reasons": reject_reasons,
    "clean_rows": clean_rows,
    "rejected_lookup": rejected_lookup,
    "stored_lookup": stored_lookup,
    "iso_format": iso_format,
    "running_watermark": running_watermark,
    "lateness_class": lateness_class,
    "post_close_rows": post_close_rows,
    "first_copy": first_copy,
    "duplicate_copies": duplicate_copies,
    "dedup_ttl": dedup_ttl,
    "too_late_replay": too_late_replay,
    "replay_check": replay_check,
    "kind_report": kind_report,
    "reason_report": reason_report,
    "run_reasons": run_reasons,
    "flight_counts": flight_counts,
    "job_counters": job_counters,
    "feed_counters": feed_counters,
    "latest_rows": latest_rows,
    "latest_rejected": latest_rejected,
    "latest_minutes": latest_minutes,
    "reconcile_ids": reconcile_ids,
    "lost_ids": lost_ids,
    "partition_skew": partition_skew,
    "subtask_skew": subtask_skew,
    "hot_key": hot_key,
    "offset_progress": offset_progress,
    "throughput": throughput,
}
