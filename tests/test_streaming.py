"""The streaming job on scripted timelines, with restarts and failures."""

import pytest
from pyspark.sql import functions as F

from tests.messages import Clock, Topic, W, at, message, ms
from wakeline.schema import TOPIC_RECORD
from wakeline.settings import Rules
from wakeline.sources.readers import jsonl_stream, open_stream, positioned, recorded_stream
from wakeline.streaming import tables
from wakeline.streaming.job import QualityJob

AC, FL = "AC-101", "AC-101-T"


def reading(name, second, **other):
    return message(name, AC, FL, None if second is None else at(second), **other)


def drain(job, stream):
    query = job.start(stream, available_now=True)
    try:
        assert query.awaitTermination(240)
        assert query.exception() is None
    finally:
        query.stop()


class Run:
    """A job over a recorded topic. Batches go through a streaming query, or
    straight into the job where the test is about the batch alone."""

    def __init__(self, spark, tmp_path, rules=Rules(), streamed=True):
        self.streamed = streamed
        self.spark = spark
        self.topic = Topic(tmp_path / "topic")
        self.root = str(tmp_path / "job")
        self.clock = Clock(W)
        self.rules = rules
        self.job = QualityJob(spark, self.root, rules, self.clock)

    def batch(self, *messages, seconds=15, partition=0):
        self.clock.forward(seconds)
        self.topic.send(*messages, partition=partition, when=self.clock.moment())
        if self.streamed:
            drain(self.job, recorded_stream(self.spark, str(self.topic.folder)))
        else:
            batch_id = self.topic.files - 1
            file = str(self.topic.folder / f"{batch_id:06d}.json")
            records = self.spark.read.schema(TOPIC_RECORD).json(file)
            self.job.process(positioned(records), batch_id)

    def table(self, name):
        return tables.read_table(self.spark, self.root, name)

    def detail(self):
        return sorted((r.event_id, r.late) for r in self.table("detail").collect())

    def rejected(self):
        return sorted((r.event_id or "", r.reason) for r in self.table("rejected").collect())

    def minutes(self):
        return sorted(
            (ms_of(r.window_start), r.event_count, r.late_count)
            for r in self.table("minutes")
            .select(F.unix_millis("window_start").alias("window_start"), "event_count", "late_count")
            .collect()
        )


def ms_of(value):
    return (value - ms(W)) // 1000


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


@pytest.fixture
def batches(spark, tmp_path):
    return Run(spark, tmp_path, streamed=False)


# Seconds of three batches of readings, by what each shows.
TIMELINE = [
    {"first": 10, "second": 30, "first again": 10, "fast": 50, "back a little": 47},
    {"behind": 37, "closing": 70},
    {"after closing": 55, "too far behind": 5},
]
SPEEDS = {"fast": 470, "back a little": 468}


def test_timeline(run):
    """On-time, out-of-order, late, closing, post-close and too-late rows."""
    minutes = []
    for rows in TIMELINE:
        run.batch(*[
            reading(name.removesuffix(" again"), second, ground_speed_kts=SPEEDS.get(name, 455))
            for name, second in rows.items()
        ])
        minutes.append(run.minutes())
    assert minutes == [[], [(0, 5, 1)], [(0, 5, 1)]]
    late = {"behind", "after closing"}
    kept = {name for rows in TIMELINE for name in rows} - {"first again", "too far behind"}
    assert run.detail() == sorted((name, name in late) for name in kept)
    assert run.rejected() == [("first", "duplicate"), ("too far behind", "too_late")]
    minute = run.table("minutes").first()
    assert minute.max_ground_speed_kts == 470
    assert minute.avg_ground_speed_kts == pytest.approx((455 * 3 + 470 + 468) / 5)


def test_limits_are_strict(batches):
    batches.batch(reading("A", 100))
    # Watermark is 95: at it not late, 15 s behind late, one millisecond more too late.
    batches.batch(reading("AT", 95), reading("BEHIND", 94.999), reading("EDGE", 80), reading("OVER", 79.999))
    assert batches.detail() == [("A", False), ("AT", False), ("BEHIND", True), ("EDGE", True)]
    assert batches.rejected() == [("OVER", "too_late")]


def test_rejected_rows_move_the_watermark(batches):
    batches.batch(reading("BAD", 90, engine_temp_c=None))
    batches.batch(reading("GOOD", 80))
    assert batches.detail() == [("GOOD", True)]


def test_broken_messages(batches):
    batches.batch(
        "not json",
        "[1]",
        '{"event_id": "cut"',
        '{"event_id": "few", "event_time": "2026-03-01T12:00:01.000Z"}',
        reading("TEXT", 5, engine_temp_c="hot"),
        reading("OK", 6),
    )
    assert [row[0] for row in batches.detail()] == ["OK"]
    assert batches.rejected() == [
        ("TEXT", "missing_engine_temp"),
        ("few", "missing_aircraft_id,missing_flight_id,missing_engine_temp"),
    ]
    commit = batches.job.commit_of(0)
    assert (commit.ingested, commit.parse_failed, commit.written) == (6, 3, 1)


def test_restart_keeps_memory_and_open_minute(spark, run):
    run.batch(reading("A", 10), reading("B", 25))
    before = run.job.commit_of(0)
    run.job = QualityJob(spark, run.root, run.rules, run.clock)
    run.batch(reading("A", 10), reading("C", 80))
    assert run.job.commit_of(1).watermark_ms > before.watermark_ms
    assert [row[0] for row in run.detail()] == ["A", "B", "C"]
    assert run.rejected() == [("A", "duplicate")]
    assert run.minutes() == [(0, 2, 0)]


def test_memory_ends_after_an_hour(batches):
    batches.batch(reading("A", 0))
    batches.batch(reading("A", 1), seconds=1800)
    batches.batch(reading("A", 2), seconds=1799.999)
    assert batches.rejected() == [("A", "duplicate")] * 2
    batches.batch(reading("A", 3), seconds=0.001)
    assert [row[0] for row in batches.detail()] == ["A", "A"]
    batches.batch(reading("A", 4), seconds=3599)
    assert len(batches.rejected()) == 3


@pytest.mark.parametrize("broken", ["rejected", "minutes", "state/open_minutes", "commits"])
def test_failed_batch_repeats_itself(spark, tmp_path, broken):
    run = Run(spark, tmp_path)
    run.batch(reading("A", 10), reading("B", 20))

    class Failing(QualityJob):
        def _write(self, rows, table, batch_id):
            if table == broken:
                raise OSError("disk gone")
            super()._write(rows, table, batch_id)

    good = run.job
    run.job = Failing(spark, run.root, run.rules, run.clock)
    with pytest.raises(Exception, match="disk gone"):
        run.batch(reading("A", 10), reading("C", 30), reading("D", 70))
    assert [row[0] for row in run.detail()] == ["A", "B"]

    run.job = good
    run.clock.forward(100)
    drain(run.job, recorded_stream(spark, str(run.topic.folder)))
    assert [row[0] for row in run.detail()] == ["A", "B", "C", "D"]
    assert run.rejected() == [("A", "duplicate")]
    assert run.minutes() == [(0, 3, 0)]


def test_committed_batch_is_not_repeated(batches):
    batches.batch(reading("A", 10))
    records = batches.spark.read.schema(TOPIC_RECORD).json(str(batches.topic.folder))
    batches.job.process(positioned(records), 0)
    assert batches.rejected() == []
    with pytest.raises(RuntimeError, match="does not follow"):
        batches.job.process(positioned(records), 5)


@pytest.mark.parametrize("expired", [False, True])
def test_a_lost_checkpoint_is_an_error(spark, batches, expired):
    """Batches numbered from 0 again neither overwrite nor vanish."""
    for name in "ABC":
        batches.batch(reading(name, 10))
    if expired:
        tables.expire_state(spark, batches.root)
    other = Topic(batches.topic.folder.parent / "other")
    other.send(reading("D", 11))
    again = QualityJob(spark, batches.root, batches.rules, batches.clock)
    records = spark.read.schema(TOPIC_RECORD).json(str(other.folder))
    for batch_id in (0, 1, 2):
        with pytest.raises(RuntimeError):
            again.process(positioned(records), batch_id)
    assert [row[0] for row in batches.detail()] == ["A", "B", "C"]


def test_remembered_ids_are_read_from_few_folders(batches):
    for place in range(5):
        batches.batch(reading(f"id {place}", place))
        recent = batches.job.commit_of(place).recent
        assert len(recent) == bin(place + 1).count("1")
    batches.batch(*[reading(f"id {place}", 12) for place in range(5)])
    assert len(batches.rejected()) == 5


def test_slow_idle_and_returning_partitions(batches):
    def reached():
        batch = tables.last_commit(batches.spark, batches.root)
        return (batches.job.commit_of(batch).watermark_ms - ms(W)) / 1000

    batches.batch(reading("P0", 100), seconds=1)
    assert reached() == 95
    batches.batch(reading("P1", 40), seconds=1, partition=1)
    assert reached() == 95, "a slow partition does not pull the watermark back"
    batches.batch(reading("P0b", 200), seconds=5)
    assert reached() == 95, "a slow partition holds the watermark"
    batches.batch(reading("P0c", 210), seconds=5)
    assert reached() == 205, "after ten seconds the slow partition is idle"
    batches.batch(reading("P1b", 50), seconds=1, partition=1)
    assert reached() == 205, "a returning partition does not pull it back"
    batches.batch(reading("P0d", 300), seconds=1)
    assert reached() == 205, "a returning partition holds it again"
    assert ("P1b", "too_late") in batches.rejected()


def test_failures_are_retried_from_the_last_commit(spark, run):
    failures = iter([True, False, True, False])

    class Flaky(QualityJob):
        def _write(self, rows, table, batch_id):
            if table == "detail" and next(failures, False):
                raise OSError("lost")
            super()._write(rows, table, batch_id)

    run.topic.send(reading("A", 10), reading("B", 20))
    run.topic.send(reading("A", 10), reading("C", 80))
    job = Flaky(spark, run.root, run.rules, run.clock)
    opened = lambda: recorded_stream(spark, str(run.topic.folder))
    job.run(opened, attempts=2, delay_s=0, available_now=True)
    assert [row[0] for row in run.detail()] == ["A", "B", "C"]
    assert run.rejected() == [("A", "duplicate")]
    counters = tables.read_commits(spark, run.root).selectExpr("sum(ingested)", "sum(written)")
    assert tuple(counters.first()) == (4, 3)


def test_second_query_is_refused(spark, run):
    run.topic.send(reading("A", 1))
    stream = recorded_stream(spark, str(run.topic.folder))
    query = run.job.start(stream, every="1 second")
    try:
        with pytest.raises(RuntimeError, match="already running"):
            run.job.start(stream)
    finally:
        query.stop()


def test_json_lines(spark, tmp_path):
    import json

    folder = tmp_path / "lines"
    folder.mkdir()
    rows = [reading("A", 1), reading("B", 2), reading("A", 1)]
    (folder / "a.jsonl").write_text("\n\n".join(json.dumps(row) for row in rows) + "\n")
    job = QualityJob(spark, str(tmp_path / "job"), clock=Clock(W))
    drain(job, jsonl_stream(spark, str(folder)))
    detail = tables.read_table(spark, job.root, "detail")
    assert sorted(row.event_id for row in detail.collect()) == ["A", "B"]
    rejected = tables.read_table(spark, job.root, "rejected").collect()
    assert [(row.event_id, row.reason, row.kafka_offset) for row in rejected] == [("A", "duplicate", 2)]


def test_source_choice(spark, tmp_path):
    with pytest.raises(ValueError):
        open_stream(spark, "kafka")
    with pytest.raises(ValueError):
        open_stream(spark, "file")
    (tmp_path / "in").mkdir()
    assert open_stream(spark, path=str(tmp_path / "in")).columns == ["raw"]


def test_merge_and_expire(spark, batches):
    batches.batch(reading("A", 1), reading("B", 2))
    batches.batch(reading("C", 70), message("D", "AC-9", FL, at(71)), message("E", "", FL, at(72)))
    whole = {name: sorted(map(str, batches.table(name).collect())) for name in tables.TABLES}
    for name in tables.TABLES:
        assert tables.merge_files(spark, batches.root, name, 1000) == 0
        assert sorted(map(str, batches.table(name).collect())) == whole[name]
    assert tables.merge_files(spark, batches.root, "detail", 1500) is None
    batches.batch(reading("F", 75))
    assert batches.table("detail").count() == 5
    assert tables.merge_files(spark, batches.root, "detail", 2000) == 1
    assert tables.expire(spark, batches.root, "detail", 1000) == 0
    assert tables.expire(spark, batches.root, "detail", 2000) == 2
    assert batches.table("detail").count() == 5
    assert tables.expire(spark, batches.root, "detail", 2001) == 1
    assert batches.table("detail").count() == 5
    assert tables.expire_state(spark, batches.root) > 0
    batches.batch(reading("A", 80), reading("G", 81))
    assert ("A", "duplicate") in batches.rejected()
    assert batches.table("detail").count() == 6
