"""Runs a batch on a small cluster of its own, one executor of which dies inside it.

Called by ``test_recovery.py`` in a process of its own: python lost_executor.py FOLDER.
"""

import json
import os
import signal
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wakeline.operators import reconcile  # noqa: E402
from wakeline.plans.replay import Replay  # noqa: E402
from wakeline.sources.feed import feed, wire_feed, with_offsets  # noqa: E402
from wakeline.sources.wire import decode  # noqa: E402
from wakeline.streaming import tables  # noqa: E402
from wakeline.streaming.job import QualityJob  # noqa: E402


def dying(marker):
    """Passes rows on; the first task to come here takes its executor down with it."""

    def work(batches):
        for batch in batches:
            try:
                os.close(os.open(marker, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                pass
            else:
                with open(f"/proc/{os.getppid()}/stat") as stat:
                    executor = int(stat.read().rsplit(")", 1)[1].split()[1])
                os.kill(executor, signal.SIGKILL)
            yield batch

    return work


def main(folder):
    home = str(Path(__file__).resolve().parents[1])
    spark = (
        SparkSession.builder.master("local-cluster[2,2,1024]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.executorEnv.PYTHONPATH", f"{home}:{os.environ.get('PYTHONPATH', '')}")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    arrivals = feed(spark, "/root/testdata/sf0.001").withColumn("kafka_partition", F.lit(0))
    wire_feed(with_offsets(arrivals, arrivals)).write.parquet(f"{folder}/topic")
    topic = spark.read.parquet(f"{folder}/topic")
    raw = topic.select("raw", "kafka_partition", "kafka_offset", "kafka_timestamp")
    last = topic.agg(F.max("kafka_offset")).first()[0]
    job = QualityJob(spark, f"{folder}/job")
    for number in range(2):
        low, high = (last + 1) * number // 2, (last + 1) * (number + 1) // 2
        part = raw.where((F.col("kafka_offset") >= low) & (F.col("kafka_offset") < high))
        if number:
            part = part.repartition(4).mapInArrow(dying(f"{folder}/died"), part.schema)
        job.process(part, number)
    replay = Replay(decode(topic))
    detail = tables.read_table(spark, job.root, "detail")
    result = {
        "died": os.path.exists(f"{folder}/died"),
        "ok": reconcile.reconcile_ids(replay.detail, detail).first().ok,
        "detail": detail.count(),
        "want_detail": replay.detail.count(),
        "rejected": tables.read_table(spark, job.root, "rejected").count(),
        "want_rejected": replay.rejected.count(),
        "minutes": tables.read_table(spark, job.root, "minutes").count(),
        "want_minutes": replay.minutes.count(),
        "difference": detail.drop("ingest_time").exceptAll(replay.detail.drop("ingest_time")).count(),
    }
    print("RESULT " + json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
