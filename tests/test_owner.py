"""One driver at a time works in a job's folder."""

import pytest

from tests.messages import Clock, W
from wakeline.sources import storage
from wakeline.streaming.job import QualityJob


def job(spark, tmp_path, owner, **other):
    return QualityJob(spark, str(tmp_path / "job"), clock=Clock(W), owner=owner, **other)


def stream(spark):
    return spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS raw")


def test_another_driver_is_refused(spark, tmp_path):
    job(spark, tmp_path, "one")._claim(take_over=True)
    two = job(spark, tmp_path, "two")
    with pytest.raises(RuntimeError, match="owned by one"):
        two.start(stream(spark))
    with pytest.raises(RuntimeError, match="owned by one"):
        two.process(spark.range(1), 0)
    assert not storage.exists(spark, f"{two.root}/begun")


def test_the_same_driver_may_start_again(spark, tmp_path):
    job(spark, tmp_path, "one")._claim(take_over=True)
    job(spark, tmp_path, "one")._claim(take_over=True)


def test_an_expired_marker_is_taken_over_at_a_start_only(spark, tmp_path):
    one = job(spark, tmp_path, "one")
    one._claim(take_over=True)
    two = job(spark, tmp_path, "two", lease_s=0)
    with pytest.raises(RuntimeError, match="owned by one"):
        two.process(spark.range(1), 0)
    two._claim(take_over=True)
    with pytest.raises(RuntimeError, match="owned by two"):
        one.process(spark.range(1), 0)


def test_a_released_folder_is_free(spark, tmp_path):
    one = job(spark, tmp_path, "one")
    one._claim(take_over=True)
    job(spark, tmp_path, "two")._release()
    assert storage.read_line(spark, f"{one.root}/owner") == "one"
    one._release()
    job(spark, tmp_path, "two")._claim(take_over=True)
