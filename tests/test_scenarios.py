"""Whole runs with known results: the 100-message mix, bulk, restart under load."""

import json

import pytest
from pyspark.sql import functions as F

from tests.messages import Clock, Topic, W, at, message
from tests.test_streaming import Run, drain
from wakeline.functions import rules as R
from wakeline.operators import reconcile, reports
from wakeline.plans import catalog_tables
from wakeline.plans.replay import Replay
from wakeline.sources.arrival import replay_feed
from wakeline.sources.readers import recorded_stream, recorded_table
from wakeline.sources.wire import decode, publish_records
from wakeline.streaming.job import QualityJob
from wakeline.streaming.native import minute_agg_stream


# How many messages of each kind, in order. Kind, count, ids shared with an
# earlier kind, seconds, and what departs from a sound reading.
FIRST_PHASE = [
    ("sound", 37, None, 120, {}),
    ("again", 8, "sound", 120, {}),
    ("hot", 15, None, 120, {"engine_temp_c": 1100}),
    ("empty id", 2, "", 120, {}),
    ("spaces as id", 1, "   ", 120, {}),
    ("empty id, no temperature", 1, "", 120, {"engine_temp_c": None}),
    ("no aircraft", 4, None, 120, {"aircraft_id": None}),
    ("no flight", 3, None, 120, {"flight_id": None}),
    ("no time", 3, None, None, {}),
    ("no temperature", 3, None, 120, {"engine_temp_c": None}),
]
SECOND_PHASE = [
    ("behind", 10, None, 110, {}),
    ("hot and behind", 5, None, 110, {"engine_temp_c": 1150}),
    ("far behind", 8, None, 60, {}),
]
RUN, PLANE = "mix/", "plane 1"


def phase(table):
    rows = []
    for kind, count, shared, second, departs in table:
        for i in range(count):
            blank = shared is not None and not shared.strip()
            name = shared if blank else f"{RUN}{shared or kind}/{i}"
            when = None if second is None else at(second)
            rows.append(message(name, PLANE, "plane 1 leg 1", when) | departs)
    return rows


def scenario():
    """100 messages of one aircraft in two phases."""
    return phase(FIRST_PHASE), phase(SECOND_PHASE)


def test_single_messages(spark, tmp_path):
    """A reading, its copy, an overheated one, and one too far behind another."""
    run = Run(spark, tmp_path, streamed=False)
    run.batch(message("NORMAL", "plane 1", "leg 1", at(0)))
    run.batch(message("NORMAL", "plane 1", "leg 1", at(0)))
    run.batch(message("OVERHEAT", "plane 2", "leg 2", at(0), engine_temp_c=1000.5))
    run.batch(message("AHEAD", "plane 3", "leg 3", at(45)))
    run.batch(message("BEHIND", "plane 3", "leg 3", at(10)))
    assert run.rejected() == [("BEHIND", "too_late"), ("NORMAL", "duplicate")]
    hot = {row.event_id: row.overheat for row in run.table("detail").collect()}
    assert hot == {"NORMAL": False, "OVERHEAT": True, "AHEAD": False}
    assert run.minutes() == []


KINDS = [
    (f"{RUN}hot and behind/%", "late_overheat"),
    (f"{RUN}behind/%", "late"),
    (f"{RUN}hot/%", "overheat"),
    (f"{RUN}sound/%", "normal"),
]
EXPECTED_KINDS = [
    ("late", 10, 0, 10),
    ("late_overheat", 5, 5, 5),
    ("normal", 37, 0, 0),
    ("overheat", 15, 15, 0),
]
EXPECTED_REASONS = {
    "blank_event_id": 3,
    "blank_event_id,missing_engine_temp": 1,
    "duplicate": 8,
    "missing_aircraft_id": 4,
    "missing_engine_temp": 3,
    "missing_event_time": 3,
    "missing_flight_id": 3,
    "too_late": 8,
}


def check_scenario(detail, rejected):
    kinds = reports.kind_report(detail, KINDS).collect()
    assert [tuple(row) for row in kinds] == EXPECTED_KINDS
    reasons = reports.reason_report(rejected).collect()
    assert {row.reason: row.cnt for row in reasons} == EXPECTED_REASONS


def test_scenario_streamed(spark, tmp_path):
    run = Run(spark, tmp_path, streamed=False)
    first, second = scenario()
    run.batch(*first)
    run.batch(*second)
    check_scenario(run.table("detail"), run.table("rejected"))
    own = reports.of_run(run.table("rejected"), RUN, PLANE)
    assert own.count() == 33


def arrivals(spark, messages):
    rows = [(i, i % 3, i // 3, json.dumps(text)) for i, text in enumerate(messages)]
    raw = spark.createDataFrame(
        rows, "arrival_seq long, kafka_partition int, kafka_offset long, raw string"
    )
    moment = F.timestamp_millis(F.col("arrival_seq") * 100)
    return decode(raw.withColumns({"kafka_timestamp": moment, "proc_time": moment}))


def test_scenario_replayed(spark):
    first, second = scenario()
    replay = Replay(arrivals(spark, first + second))
    check_scenario(replay.first, replay.rejected)


def timeline():
    texts = [
        ("A", 10), ("B", 30), ("A", 10), ("C", 50), ("D", 47), ("E", 37), ("F", 70),
        ("G", 55), ("H", 5), ("I", 130), ("J", 110), ("B", 131),
    ]
    return [message(name, "AC-1", "F-1", at(second)) for name, second in texts]


def test_row_by_row_stream_equals_replay(spark, tmp_path):
    """Fed one message per batch, the stream and the replay must agree exactly."""
    messages = timeline()
    run = Run(spark, tmp_path, streamed=False)
    rows = [(json.dumps(text), 0, i, None) for i, text in enumerate(messages)]
    schema = "raw string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp"
    for batch_id, row in enumerate(rows):
        run.clock.forward(1)
        run.job.process(spark.createDataFrame([row], schema), batch_id)
    replay = Replay(arrivals(spark, messages))
    assert run.detail() == sorted((r.event_id, r.late) for r in replay.first.collect())
    assert run.rejected() == sorted((r.event_id, r.reason) for r in replay.rejected.collect())
    got = run.table("minutes").drop("window_start", "window_end").collect()
    want = replay.minutes.drop("window_start", "window_end").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_recorded_topic_replayed(spark, tmp_path):
    topic = Topic(tmp_path / "topic")
    topic.send(*timeline(), "no json")
    replay = Replay(replay_feed(recorded_table(spark, str(topic.folder))))
    assert sorted((r.event_id, r.reason) for r in replay.rejected.collect()) == [
        ("A", "duplicate"), ("B", "duplicate"), ("H", "too_late"),
    ]
    assert replay.detail.count() == 9


def test_no_id_is_lost_or_doubled_over_a_failure(spark, tmp_path):
    """20,000 ids in four batches, the job dying half-way through the third."""
    ids = 20_000
    topic = Topic(tmp_path / "topic")
    spark.range(0, ids, 1, 4).select(
        F.lit("k").alias("key"),
        F.to_json(
            F.struct(
                F.format_string("REC-%06d", "id").alias("event_id"),
                F.format_string("AC-%03d", F.col("id") % 10).alias("aircraft_id"),
                F.lit("REC").alias("flight_id"),
                F.lit("2026-03-01T12:00:00.000Z").alias("event_time"),
                F.lit(680.0).alias("engine_temp_c"),
            )
        ).alias("value"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit(W).alias("timestamp"),
    ).write.mode("overwrite").json(str(topic.folder))
    root = str(tmp_path / "job")

    class Dying(QualityJob):
        def _write(self, rows, table, batch_id):
            if table == "rejected" and batch_id == 2:
                raise OSError("worker lost")
            super()._write(rows, table, batch_id)

    clock = Clock(W)
    stream = recorded_stream(spark, str(topic.folder))
    with pytest.raises(Exception, match="worker lost"):
        drain(Dying(spark, root, clock=clock), stream)
    job = QualityJob(spark, root, clock=clock)
    drain(job, recorded_stream(spark, str(topic.folder)))

    from wakeline.streaming.tables import read_table

    produced = spark.range(ids).select(F.format_string("REC-%06d", "id").alias("event_id"))
    verdict = reconcile.reconcile_ids(produced, read_table(spark, root, "detail")).first()
    assert verdict.asDict() == {
        "produced": ids, "rows": ids, "distinct_ids": ids, "missing": 0, "unexpected": 0,
        "duplicate_rows": 0, "ok": True,
    }
    assert read_table(spark, root, "rejected").count() == 0


def test_native_minutes(spark, tmp_path):
    """Spark's own window state agrees on which rows enter a minute."""
    run = Run(spark, tmp_path)
    run.topic.send(*[message(f"a{s}", "AC-1", "F", at(s)) for s in (10, 30, 50, 47)])
    run.topic.send(
        message("late", "AC-1", "F", at(37)),
        message("bad", "AC-1", "F", at(70), engine_temp_c=None),
    )
    run.topic.send(message("next", "AC-1", "F", at(71)))
    run.topic.send(message("pc", "AC-1", "F", at(55)), message("far", "AC-1", "F", at(110)))
    rows = decode(recorded_stream(spark, str(run.topic.folder)))
    query = (
        minute_agg_stream(rows)
        .writeStream.format("memory").queryName("native_minutes").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "native"))
        .trigger(availableNow=True).start()
    )
    try:
        assert query.awaitTermination(240)
    finally:
        query.stop()
    found = spark.table("native_minutes").where("window_start = timestamp'2026-03-01 12:00:00'")
    assert [row.event_count for row in found.collect()] == [5]
    assert spark.table("native_minutes").where("window_end = timestamp'2026-03-01 12:02:00'").count() == 0


def test_catalog_tables(spark, tmp_path):
    db = "wakeline_test"
    catalog_tables.create_tables(spark, db)
    try:
        catalog_tables.create_tables(spark, db)
        assert catalog_tables.list_tables(spark, db) == sorted(catalog_tables.TABLES)
        assert db in catalog_tables.list_databases(spark)
        replay = Replay(arrivals(spark, timeline()))
        catalog_tables.save_replay(replay, db)
        for name, want in (
            ("detail", replay.detail), ("rejected", replay.rejected), ("minute", replay.minutes)
        ):
            got = spark.table(f"{db}.telemetry_{name}").select(want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
        target = str(tmp_path / "clean")
        catalog_tables.append_clean_records(replay, target)
        assert spark.read.json(target).count() == replay.detail.count()
    finally:
        catalog_tables.reset_tables(spark, db)
        assert catalog_tables.list_tables(spark, db) == []
        spark.sql(f"DROP DATABASE {db}")


def test_published_messages_come_back(spark):
    rows = arrivals(spark, [message("A", "AC-1", "F", at(1)), message(None, "AC-1", "F", None)])
    sent = publish_records(rows)
    assert sent.columns == ["key", "value"]
    assert '"event_id":null' in sent.orderBy("value").collect()[1].value + sent.orderBy("value").collect()[0].value
    back = decode(sent.withColumnRenamed("value", "raw")).drop("key")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.select(back.columns).collect()))
