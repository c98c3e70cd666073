"""Operators against plain Python on small rows, and under forced skew."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from wakeline.functions import rules as R
from wakeline.functions.timetext import iso_ms, parse_iso
from wakeline.operators import dedup
from wakeline.operators.balance import hottest_key, reader_share
from wakeline.operators.eventtime import with_watermark_column
from wakeline.operators.reconcile import lost_ids, reconcile_ids
from wakeline.operators.running import running
from wakeline.settings import Rules
from wakeline.sources.arrival import with_arrival_order
from wakeline.sources.staging import staged
from wakeline.sources.wire import decode


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_running_aggregates(spark, monkeypatch, width):
    monkeypatch.setattr("wakeline.operators.running.FAN_OUT", 3)
    rng = random.Random(width)
    seqs = sorted(rng.sample(range(5000), 300))
    rows = [(s, rng.choice("ab"), rng.choice([None, rng.randint(0, 99)])) for s in seqs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "seq long, k string, v int")
    values = {"hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "n": ("sum", F.lit(1))}
    for keys in ([], ["k"]):
        for current in (True, False):
            got = {
                r.seq: (r.hi, r.lo, r.n)
                for r in running(df, "seq", values, keys, current, width).collect()
            }
            want = {}
            for key in ["a", "b"] if keys else [None]:
                past = []
                for seq, k, v in sorted(rows):
                    if key and k != key:
                        continue
                    seen = past + [(v,)] if current else past
                    known = [x for (x,) in seen if x is not None]
                    want[seq] = (
                        max(known, default=None),
                        min(known, default=None),
                        len(seen) or None,
                    )
                    past = past + [(v,)]
            assert got == want


def test_running_shuffles_the_rows_once(spark, tmp_path):
    """Rows are sorted once for window and join; bucket totals are read once."""
    spark.range(1000).selectExpr("id", "id * 7 % 100 AS v").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    result = running(rows, "id", {"hi": ("max", F.col("v"))}, width=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result.count() == 1000
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final
    assert final.count("Sort [_bucket#") == 3, "rows, their carry, and the groups"
    assert final.count("SinglePartition") == 1


def test_running_handles_structs(spark):
    df = spark.range(20).withColumn("pair", F.struct("id", (F.col("id") % 3).alias("m")))
    got = running(df, "id", {"last": ("max", F.when(F.col("id") % 5 == 0, F.col("pair")))}, width=4)
    assert all(row.last.id == row.id // 5 * 5 for row in got.collect())


def test_watermark_of_rows_without_time(spark):
    df = spark.createDataFrame(
        [(0, None), (1, 100), (2, None), (3, 90)], "arrival_seq long, t long"
    ).withColumn("event_time", F.timestamp_seconds("t"))
    got = with_watermark_column(df).select("arrival_seq", F.unix_seconds("watermark")).collect()
    assert sorted(map(tuple, got)) == [(0, None), (1, 95), (2, 95), (3, 95)]


def accepted_by_hand(rows, ttl):
    last, kept = {}, set()
    for seq, name, at in sorted(rows):
        if name not in last or at >= last[name] + ttl:
            last[name] = at
            kept.add(seq)
    return kept


@pytest.mark.parametrize("ttl", [7, 100, 500])
def test_dedup_with_a_hot_id(spark, ttl):
    """A third of the rows share one id; short memories make long walks."""
    rng = random.Random(3)
    rows, at = [], 0
    for seq in range(900):
        at += rng.choice([0, 1, 1, 2, 9])
        # Some ids have two copies or one, most have several.
        name = "hot" if rng.random() < 0.34 else f"id{int(rng.paretovariate(0.5)) % 300}"
        rows.append((seq, name, at))
    df = spark.createDataFrame(rows, "arrival_seq long, event_id string, t long").withColumn(
        "proc_time", F.timestamp_seconds("t")
    )
    got = dedup.accepted_positions(df, rules=Rules(dedup_ttl_s=ttl))
    found = [row.arrival_seq for row in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == accepted_by_hand(rows, ttl)
    marked = dedup.mark_first(df, got)
    assert {r.arrival_seq for r in marked.where("is_first").collect()} == set(found)
    assert marked.count() == len(rows)


def test_dedup_keeps_the_first_of_many_and_no_array_of_them(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_millis("id").alias("proc_time"),
    )
    assert dedup.accepted_positions(df).count() == 1 + 20_000 - 6667


@pytest.mark.parametrize("copies, memory_s", [(5_760, 3600), (50_000, 3600), (300, 59)])
def test_one_id_seen_for_weeks_takes_few_writes(spark, monkeypatch, copies, memory_s):
    """One id, once a minute: writes grow with the logarithm of its history."""
    writes = []

    def counted(df, name):
        writes.append(name)
        return staged(df, name)

    monkeypatch.setattr(dedup, "staged", counted)
    df = spark.range(copies).select(
        F.col("id").alias("arrival_seq"),
        F.lit("busy").alias("event_id"),
        F.timestamp_seconds(F.col("id") * 60 + 17).alias("proc_time"),
    )
    found = dedup.accepted_positions(df, rules=Rules(dedup_ttl_s=memory_s)).collect()
    every = max(1, memory_s // 60)
    assert sorted(row.arrival_seq for row in found) == list(range(0, copies, every))
    assert len(writes) <= 16


def test_reasons(spark):
    df = spark.createDataFrame(
        [
            ("a", "x", "f", 100, 1.0),
            (None, " ", "", None, None),
            ("\t", "x", "f", 100, 1000.0),
            ("a", "x", "f", 79, 1000.1),
            (" ", "x", "f", 79, None),
        ],
        "event_id string, aircraft_id string, flight_id string, t long, engine_temp_c double",
    ).withColumn("event_time", F.timestamp_seconds("t"))
    tagged = R.tag(df, F.timestamp_seconds(F.lit(95)))
    assert [tuple(r) for r in tagged.select("reject_reason", "overheat", "late").collect()] == [
        (None, False, False),
        (
            "blank_event_id,missing_aircraft_id,missing_flight_id,missing_event_time,"
            "missing_engine_temp",
            False,
            False,
        ),
        (None, False, False),
        ("too_late", True, True),
        ("blank_event_id,missing_engine_temp,too_late", False, True),
    ]


def test_odd_fields(spark):
    """Numbers may come as text; times must be ISO-8601 in UTC."""
    cases = [
        ('{"engine_temp_c": 680, "event_id": 7}', ("7", 680.0, None)),
        ('{"engine_temp_c": "680.5", "event_time": "2026-01-01T00:00:00Z"}', (None, 680.5, 0)),
        ('{"engine_temp_c": "hot", "event_time": "2026-01-01T00:00:01.2349Z"}', (None, None, 1234)),
        ('{"engine_temp_c": true, "event_time": "2026-01-01 00:00:00"}', (None, None, None)),
        ('{"engine_temp_c": {"a": 1}, "event_time": "2026-01-01T00:00:00+01:00"}', (None, None, None)),
        ('{"engine_temp_c": null, "event_time": 5}', (None, None, None)),
        ('{"event_time": "2026-13-01T00:00:00Z", "more": [1]}', (None, None, None)),
    ]
    raw = spark.createDataFrame([(text,) for text, _ in cases], "raw string").coalesce(1)
    base = 1767225600000
    got = decode(raw).select("event_id", "engine_temp_c", F.unix_millis("event_time") - base)
    assert [tuple(row) for row in got.collect()] == [want for _, want in cases]
    skipped = ["", "null", "1", "[]", '"text"', '{"event_id": "a"', "junk"]
    raw = spark.createDataFrame([(text,) for text in [*skipped, None]], "raw string")
    assert decode(raw).count() == 0


def test_overheat_is_strict_and_ignores_nan(spark):
    temps = [999.0, 1000.0, 1000.1, None, float("nan")]
    df = spark.createDataFrame([(t,) for t in temps], "engine_temp_c double").coalesce(1)
    assert [r[0] for r in df.select(R.overheat()).collect()] == [False, False, True, False, False]


def test_unknown_watermark_rejects_nothing(spark):
    df = spark.sql("SELECT 'a' AS event_id, 'b' AS aircraft_id, 'c' AS flight_id, "
                   "timestamp'2026-01-01' AS event_time, 1D AS engine_temp_c")
    row = R.tag(df, F.lit(None).cast("timestamp")).first()
    assert (row.late, row.reject_reason) == (False, None)


def test_iso_text_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_millis(1767225600123) AS t")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = df.select(iso_ms(F.col("t")).alias("text"), F.unix_millis(parse_iso(iso_ms(F.col("t"))))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == ("2026-01-01T00:00:00.123Z", 1767225600123)
    assert spark.sql("SELECT 'junk' AS t").select(parse_iso(F.col("t"))).first()[0] is None


def test_hottest_key(spark):
    rows = spark.range(50).selectExpr("CASE WHEN id < 20 THEN 'a' ELSE 'k' || id END AS aircraft_id")
    assert tuple(hottest_key(rows).first()) == ("a", 20, 50, 0.4)


def test_reader_share(spark):
    # Rows per partition and the shares published for them.
    counts = [2546, 3275, 1815, 26545, 1816, 4002, 2182, 3636, 4725, 4366, 2546, 2546]
    rows = spark.createDataFrame(list(enumerate(counts)), "kafka_partition int, n int").selectExpr(
        "kafka_partition", "explode(sequence(1, n))"
    )
    shares = {r.subtask: (r.rows, round(r.share, 3)) for r in reader_share(rows).collect()}
    assert shares == {0: (35639, 0.594), 1: (11273, 0.188), 2: (13088, 0.218)}


def test_reconciliation_finds_each_kind_of_difference(spark):
    produced = spark.createDataFrame([(x,) for x in "abcd"], "event_id string")
    stored = spark.createDataFrame([(x,) for x in "aabz"], "event_id string")
    assert tuple(reconcile_ids(produced, stored).first()) == (4, 4, 3, 2, 1, 1, False)
    assert sorted(r.event_id for r in lost_ids(produced, stored).collect()) == ["c", "d"]
    assert reconcile_ids(produced, produced).first().ok


def test_arrival_order(spark):
    rng = random.Random(5)
    rows = [(t, p, o) for t in range(3) for p in range(4) for o in range(t * 9, t * 9 + 9)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t long, kafka_partition int, kafka_offset long").withColumn(
        "proc_time", F.timestamp_seconds("t")
    )
    numbered = with_arrival_order(df.repartition(5)).orderBy("arrival_seq").collect()
    assert [(r.t, r.kafka_partition, r.kafka_offset) for r in numbered] == sorted(rows)
    assert len({r.arrival_seq for r in numbered}) == len(rows)
