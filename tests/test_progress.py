"""Progress of the stream over a restart, counters as rows pass, and passes over a batch."""

import json
import time

import pytest

from tests.messages import Clock, Topic, W, at, message
from wakeline.functions import rules as R
from wakeline.operators.reports import stage_counters
from wakeline.sources.growing import growing_lines
from wakeline.streaming import tables
from wakeline.streaming.job import QualityJob
from wakeline.streaming.progress import flat_offsets, offset_report, rate_report, read_progress


def lines(*names, second=5):
    return "".join(json.dumps(message(n, "AC-1", "AC-1-Z", at(second))) + "\n" for n in names)


def test_offsets_are_not_rewound_over_a_restart(spark, tmp_path):
    path = tmp_path / "feed.jsonl"
    path.write_text("")
    root = str(tmp_path / "job")
    sent = 0
    for turn in range(3):
        job = QualityJob(spark, root, clock=Clock(at(turn)))
        query = job.start(growing_lines(spark, str(path), starting="start"), every="1 second")
        try:
            for _ in range(2):
                with open(path, "a") as file:
                    file.write(lines(f"E{sent}", f"E{sent + 1}"))
                sent += 2
                query.processAllAvailable()
        finally:
            query.stop()
            query.awaitTermination(60)
    deadline = time.time() + 30
    while read_progress(spark, root).count() < 6 and time.time() < deadline:
        time.sleep(0.5)
    (row,) = offset_report(read_progress(spark, root)).collect()
    assert row.source_partition == f"bytes/{path}"
    assert (row.first_offset, row.last_offset) == (None, path.stat().st_size)
    assert (row.batches, row.runs, row.rewound, row.skipped) == (6, 3, 0, 0)
    rates = rate_report(read_progress(spark, root)).orderBy("batch_id").collect()
    assert sum(r.rows for r in rates) == sent and all(r.processed_per_s > 0 for r in rates)
    assert tables.read_table(spark, root, "detail").count() == sent
    again = spark.createDataFrame([("q", 0, "p", b, s, e, "r") for b, s, e in ((0, 0, 5), (1, 3, 9), (2, 11, 12))],
        "query string, source int, source_partition string, batch_id long, start_offset long, end_offset long, run_id string")
    (row,) = offset_report(again).collect()
    assert (row.rewound, row.skipped) == (1, 1)
    assert read_progress(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize(
    ("offset", "want"),
    [
        (None, {}),
        ("None", {}),
        ('{"t":{"0":5,"1":7}}', {"t/0": 5, "t/1": 7}),
        ('{"logOffset":3}', {"logOffset": 3}),
        ("12", {"": 12}),
        ('{"a":{"b":true,"c":"x"}}', {}),
    ],
)
def test_offsets_by_name(offset, want):
    assert flat_offsets(offset) == want


def test_counters_are_those_of_a_pass_over_the_rows(spark, tmp_path, monkeypatch):
    """Same figures as a pass of its own would give, and no such pass is made."""
    topic = Topic(tmp_path / "topic")
    sound = [message(f"E{k}", "AC-1", "AC-1-Z", at(k), engine_temp_c=900.0 + 30 * k) for k in range(8)]
    odd = [message("E1", "AC-1", "AC-1-Z", at(1)), message(" ", "AC-1", "F", at(2)), "no json", "[1]"]
    late = [message("L1", "AC-1", "F", at(-1)), message("L2", "AC-1", "F", at(-100)), message("N", None, "F", None)]
    topic.send(*sound, *odd, *late)
    from wakeline.schema import TOPIC_RECORD
    from wakeline.sources.readers import positioned

    records = positioned(spark.read.schema(TOPIC_RECORD).json(str(topic.folder)))
    job = QualityJob(spark, str(tmp_path / "job"), clock=Clock(W))
    seen = {}
    written = job._write_results

    def kept(marked, batch_id):
        seen["rows"] = marked
        seen["want"] = stage_counters(marked).first().asDict()
        return written(marked, batch_id)

    monkeypatch.setattr(job, "_write_results", kept)
    job.process(records, 0)
    commit = job.commit_of(0).asDict()
    assert {name: commit[name] for name in seen["want"]} == seen["want"]
    assert (commit["ingested"], commit["parse_failed"], commit["decoded"]) == (15, 2, 13)
    assert commit["dedup_dropped"] == 1 and commit["late_dropped"] == 1 and R.DUPLICATE == "duplicate"
