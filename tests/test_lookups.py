"""Look-ups on stored tables: the rows of a full read, from a fraction of it."""

from collections import Counter

from pyspark.sql import functions as F

from wakeline.operators.reports import lookup
from wakeline.plans.lookups import Lookups, save_lookups


def rows_read(query) -> int:
    """Rows that the scans of a collected query gave on, before its filters."""
    query.collect()
    leaves = query._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_read_a_fraction(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 1000 > 2, F.concat(F.lit("E-"), F.xxhash64("id").cast("string"))).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 > 0, F.concat(F.lit("F-"), F.col("id") % 997)).alias("flight_id"),
        F.col("id").alias("kafka_offset"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        save_lookups(rows, str(tmp_path), ["kafka_offset"], row_group_bytes=1 << 18)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = Lookups(spark, str(tmp_path))
    total = rows.count()
    some = [r.event_id for r in rows.where("event_id is not null").limit(3).collect()]
    tests = {
        "ids": (found.ids(*some), rows.where(F.col("event_id").isin(*some)), 0.2),
        "none": (found.ids("E-none"), rows.limit(0), 0.1),
        "prefixes": (found.prefixes("E-123", "E--77"), lookup(rows, "", ["E-123", "E--77"]), 0.3),
        "flight": (found.flight("F-5"), rows.where("flight_id = 'F-5'"), 0.1),
        "hot": (found.flight("hot"), rows.where("flight_id = 'hot'"), 0.5),
        "run": (found.run("F-7", ["E-55"]), lookup(rows, "F-7", ["E-55"]), 0.3),
    }
    for name, (got, want, most) in tests.items():
        assert rows_read(got) <= most * total, name
        assert Counter(r.kafka_offset for r in got.collect()) == Counter(r.kafka_offset for r in want.collect()), name
    files = spark.read.parquet(f"{tmp_path}/by_flight_id").where("flight_id = 'hot'")
    assert files.select(F.input_file_name()).distinct().count() > 1
