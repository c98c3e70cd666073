"""The stream's tables do not depend on how messages fall into batches."""

import pytest
from pyspark.sql import functions as F

from wakeline.plans.replay import Replay
from wakeline.sources.feed import feed, wire_feed, with_offsets
from wakeline.sources.wire import decode
from wakeline.streaming import tables
from wakeline.streaming.job import QualityJob

SF_DIR = "/root/testdata/sf0.001"
RAW = ("raw", "kafka_partition", "kafka_offset", "kafka_timestamp")


def rounded(rows):
    """Rows as texts; averages may differ in their last digits with the order of addition."""
    averages = {name: F.round(name, 6) for name in rows.columns if name.startswith("avg_")}
    return sorted(map(str, rows.withColumns(averages).collect()))


def streamed(spark, messages, root, batches):
    """The three tables, from batches cut at even steps of the arrival number."""
    job = QualityJob(spark, root)
    last = messages.agg(F.max("arrival_seq")).first()[0]
    for batch_id in range(batches):
        low, high = (last + 1) * batch_id // batches, (last + 1) * (batch_id + 1) // batches
        part = messages.where((F.col("arrival_seq") >= low) & (F.col("arrival_seq") < high))
        job.process(part.select(*RAW), batch_id)
    return {name: rounded(tables.read_table(spark, root, name)) for name in tables.TABLES}


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    """The feed as messages, on one partition and on its twelve."""
    found = {}
    for partitions in (1, 12):
        arrivals = feed(spark, SF_DIR)
        if partitions == 1:
            arrivals = arrivals.withColumn("kafka_partition", F.lit(0))
        folder = str(tmp_path_factory.mktemp("topic") / str(partitions))
        wire_feed(with_offsets(arrivals, arrivals)).write.parquet(folder)
        found[partitions] = spark.read.parquet(folder)
    return found


def test_one_partition_equals_the_replay(spark, topics, tmp_path):
    messages = topics[1]
    replay = Replay(decode(messages))
    want = {
        "detail": rounded(replay.detail),
        "rejected": rounded(replay.rejected),
        "minutes": rounded(replay.minutes),
    }
    assert all(want.values())
    for batches in (1, 3, 8):
        got = streamed(spark, messages, str(tmp_path / str(batches)), batches)
        assert got == want, f"{batches} batches"


def test_splits_of_twelve_partitions_agree(spark, topics, tmp_path):
    one = streamed(spark, topics[12], str(tmp_path / "one"), 1)
    assert any("too_late" in row for row in one["rejected"])
    assert streamed(spark, topics[12], str(tmp_path / "many"), 5) == one
