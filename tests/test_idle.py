"""Partitions that fall silent: minutes close while no message arrives, and stay closed."""

import time

import pytest

from tests.messages import Clock, Topic, W, at, message, ms
from wakeline.operators.arrivals import SOURCES, released_watermark
from wakeline.settings import Rules
from wakeline.sources.readers import recorded_stream
from wakeline.streaming import tables
from wakeline.streaming.idle import RELEASED, STATE_STORE
from wakeline.streaming.job import QualityJob

AC, FL = "AC-7", "AC-7-X"


def reading(name, second, **other):
    return message(name, AC, FL, at(second), **other)


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    yield
    spark.conf.set(key, before)


def test_a_minute_closes_while_no_message_arrives(spark, tmp_path, rocksdb):
    """Two partitions, one slow; both fall silent; then the slow one returns."""
    topic = Topic(tmp_path / "topic")
    job = QualityJob(spark, str(tmp_path / "job"), Rules(idle_s=6), Clock(W))
    topic.send(reading("A1", 10), reading("A2", 130), partition=0, when=at(1))
    topic.send(reading("B1", 20), partition=1, when=at(1))
    query = job.start(
        recorded_stream(spark, str(topic.folder), files_per_batch=10), every="1 second", release_idle=True
    )
    try:

        def commits():
            found = [] if tables.last_commit(spark, job.root) < 0 else tables.read_commits(spark, job.root).collect()
            return sorted(found, key=lambda row: row.batch_id)

        def until(true, seconds=150):
            end = time.time() + seconds
            while not true():
                assert query.isActive, query.exception()
                assert time.time() < end, commits()
                time.sleep(1)

        until(lambda: any(row.ingested for row in commits()))
        first = [row for row in commits() if row.ingested][0]
        # Both partitions count, and the slow one holds: nothing closes while it is waited for.
        assert first.watermark_ms is None and first.idle == []
        until(lambda: commits()[-1].idle == [0, 1])
        assert commits()[-1].watermark_ms == ms(at(125))
        closed = tables.read_table(spark, job.root, "minutes").collect()
        assert [(r.window_start.timestamp(), r.event_count) for r in closed] == [(W.timestamp(), 2)]
        # The slow partition returns with rows of the closed minute: in detail or too late, not counted.
        topic.send(reading("B2", 50), reading("B3", 118), reading("B4", 140), partition=1, when=at(40))
        until(lambda: sum(row.ingested for row in commits()) == 6)
        assert 1 not in [row for row in commits() if row.ingested][-1].idle
    finally:
        query.stop()
    again = tables.read_table(spark, job.root, "minutes").collect()
    assert [r.event_count for r in again if r.window_start.timestamp() == W.timestamp()] == [2]
    detail = {r.event_id: r.late for r in tables.read_table(spark, job.root, "detail").collect()}
    assert detail == {"A1": False, "A2": False, "B1": False, "B3": True, "B4": False}
    assert tables.expire_state(spark, job.root) > 0
    assert len(tables.read_table(spark, job.root, "detail").collect()) == 5


def test_batches_without_messages_leave_the_state(spark, tmp_path):
    """Called by hand: releases come as rows; a repeated batch changes nothing."""
    job = QualityJob(spark, str(tmp_path / "job"), Rules(), Clock(W))
    columns = "raw string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, released boolean"
    from json import dumps

    def batch(number, *rows):
        job.process(spark.createDataFrame(list(rows), columns), number)
        return job.commit_of(number)

    assert RELEASED == "released"
    sent = [(dumps(reading(f"{p}{k}", s)), p, k, at(1), False) for p, k, s in ((0, 0, 10), (1, 0, 70), (2, 0, 200))]
    one = batch(0, *sent)
    assert (one.idle, one.watermark_ms) == ([], None)
    quiet = batch(1)
    assert (quiet.watermark_ms, quiet.sources_of, quiet.minutes_of) == (None, 0, 0)
    two = batch(2, (None, 0, None, at(1), True))
    assert (two.idle, two.watermark_ms, two.sources_of, two.minutes_of) == ([0], ms(at(65)), 0, 2)
    assert tables.read_table(spark, job.root, "minutes").count() == 1
    three = batch(3, (None, 2, None, at(1), True))
    assert (three.idle, three.watermark_ms) == ([0, 2], ms(at(65)))
    four = batch(4, (None, 1, None, at(1), True))
    assert (four.idle, four.watermark_ms, four.minutes_of) == ([0, 1, 2], ms(at(195)), 4)
    assert tables.read_table(spark, job.root, "minutes").count() == 2
    batch(4, (None, 1, None, at(1), True))
    back = batch(5, (dumps(reading("01", 205)), 0, 1, at(30), False))
    assert (back.idle, back.written) == ([1, 2], 1)
    assert back.watermark_ms == ms(at(200))


def test_released_watermark(spark):
    def at_sources(*rows):
        return spark.createDataFrame([(p, s, None if n is None else at(n)) for p, s, n in rows], SOURCES)

    rows = at_sources((0, 5, 100), (1, 9, 60), (2, 7, None))
    assert released_watermark(rows, [0], ms(at(10))) == ms(at(10))
    assert released_watermark(rows, [2], None) == ms(at(55))
    assert released_watermark(rows, [1, 2], None) == ms(at(95))
    assert released_watermark(rows, [0, 1, 2], None) == ms(at(55))
    assert released_watermark(rows, [0, 1, 2], ms(at(90))) == ms(at(90))
    assert released_watermark(at_sources(), [], None) is None
