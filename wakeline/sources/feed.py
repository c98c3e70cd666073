"""Arrival feed derived from the ``events`` table.

Event times follow ``ts``: its whole range is drawn together so that a second holds one
event on average, which keeps the order and the unevenness of the gaps. Sensors follow
``value`` and ``props``. The table has unique ids in time order and no defects; the feed
gives its rows disorder, copies and defects by the event number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.running import running
from wakeline.schema import ARRIVAL
from wakeline.sources.wire import iso_payload

# Fixed values of the feed.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
START_S = 1_704_067_200  # 2024-01-01 00:00:00 UTC
PARTITIONS = 12
AIRCRAFT = 50

# Milliseconds of ``ts``, read off its fields so that no time zone touches them.
TS_MS = """(unix_date(CAST(ts AS DATE)) * 86400000L + (hour(ts) * 60 + minute(ts)) * 60000L
  + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT))"""
EVENT_MS = "(ts_ms - first_ms) * newest DIV greatest(1L, (last_ms - first_ms) DIV 1000)"

# Arrivals of one event: itself, a close copy, and under the id of an event 3700 earlier
# a copy after the dedup memory.
COPIES = """
inline(array(
  struct(0 AS copy, 10 * event_id AS arrival_seq, event_id AS n),
  CASE WHEN event_id % 20 = 11 THEN
    struct(1 AS copy,
           10 * event_id + 35 + IF(event_id % 100 = 51, 270, 0) AS arrival_seq,
           event_id AS n) END,
  CASE WHEN event_id % 1000 = 791 AND event_id > 3700 AND event_id < newest THEN
    struct(2 AS copy, 10 * event_id + 1 AS arrival_seq, event_id - 3700 AS n) END
))
"""

# Seconds an event time is moved back, by event number modulo 100.
SHIFT = """
CASE WHEN copy > 0 THEN 0
     WHEN k IN (7, 24, 27) THEN 3
     WHEN k IN (13, 53, 73) THEN 12
     WHEN k = 93 THEN 6
     WHEN k = 33 THEN 21
     WHEN k = 83 THEN 22
     WHEN k = 47 THEN 60
     WHEN k = 23 THEN -4
     ELSE 0 END
"""

COLUMNS = {
    "event_id": "CASE WHEN k IN (17, 43) THEN '' WHEN k = 37 THEN '   ' ELSE 'E-' || n END",
    "aircraft_id": "CASE WHEN k <> 57 THEN aircraft END",
    "flight_id": "CASE WHEN k <> 77 THEN aircraft || '-' || event_type END",
    "event_time": f"CASE WHEN k <> 97 THEN timestamp_millis({START_S}000 + event_ms - 1000 * shift) END",
    "latitude": "CAST(prop - 50 AS DOUBLE)",
    "longitude": "CAST(user_id % 360 - 180 AS DOUBLE)",
    "altitude_ft": "CAST(400 * prop AS DOUBLE)",
    "ground_speed_kts": "CAST(150 + 3 * prop AS DOUBLE)",
    "vertical_speed_fpm": "10 * value",
    "heading_deg": "CAST(3 * prop AS DOUBLE)",
    "engine_temp_c": "CASE WHEN k NOT IN (3, 23, 43) THEN 600 + 2 * value END",
    "oil_pressure_psi": "CAST(40 + prop % 25 AS DOUBLE)",
    "fuel_flow_kg_h": "CAST(600 + 20 * prop AS DOUBLE)",
    "fuel_remaining_kg": "CAST(16800 - 160 * prop AS DOUBLE)",
    "outside_air_temp_c": "-value",
    "kafka_partition": f"CAST(user_id % {PARTITIONS} AS INT)",
    "kafka_offset": "CAST(NULL AS BIGINT)",
    "kafka_timestamp": f"timestamp_millis({START_S}000 + 100 * arrival_seq)",
    "proc_time": f"timestamp_millis({START_S}000 + 100 * arrival_seq)",
}
assert list(COLUMNS) == ARRIVAL.fieldNames()


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with ``arrival_seq`` as their unique order.

    ``n`` and ``copy`` tell which event and which of its arrivals a row is.
    ``kafka_offset`` is left NULL; :func:`with_offsets` fills it where wanted.
    """
    events = read_events(spark, sf_dir).withColumn("ts_ms", F.expr(TS_MS))
    bounds = {
        "newest": events.agg(F.max("event_id")).scalar(),
        "first_ms": events.agg(F.min("ts_ms")).scalar(),
        "last_ms": events.agg(F.max("ts_ms")).scalar(),
    }
    return (
        events.withColumns(bounds)
        .selectExpr(
            "event_id % 100 AS k",
            "user_id",
            f"'AC-' || user_id % {AIRCRAFT} AS aircraft",
            "event_type",
            "value",
            "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS prop",
            f"{EVENT_MS} AS event_ms",
            COPIES,
        )
        .where("copy IS NOT NULL")
        .selectExpr("*", f"{SHIFT} AS shift")
        .selectExpr(
            "arrival_seq", "copy", "n", *[f"{sql} AS {name}" for name, sql in COLUMNS.items()]
        )
    )


def with_offsets(rows: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Fill ``kafka_offset`` of ``rows``: arrivals before it on its partition.

    Kept apart from the feed so that only queries showing offsets number them.
    """
    numbered = running(
        arrivals.select("arrival_seq", "kafka_partition"),
        "arrival_seq",
        {"_seen": ("sum", F.lit(1))},
        keys=["kafka_partition"],
    ).select("arrival_seq", (F.col("_seen") - 1).alias("kafka_offset"))
    return rows.drop("kafka_offset").join(numbered, "arrival_seq")


def wire_feed(arrivals: DataFrame) -> DataFrame:
    """The feed as raw JSON text with broken messages among it.

    By event number modulo 100: 31 is cut short, 71 is an array, 63 carries a
    word and 61 a number as text in a number field.
    """
    k = F.col("n") % 100
    text = iso_payload()
    raw = (
        F.when(k == 31, F.expr("left(raw, length(raw) - 1)"))
        .when(k == 71, F.concat(F.lit("["), "raw", F.lit("]")))
        .when(k == 63, F.regexp_replace("raw", '"engine_temp_c":[^,]*', '"engine_temp_c":"hot"'))
        .when(k == 61, F.regexp_replace("raw", '"engine_temp_c":([^,]*)', '"engine_temp_c":"$1"'))
        .otherwise(F.col("raw"))
    )
    built = arrivals.select(
        "arrival_seq",
        "n",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "proc_time",
        text.alias("raw"),
    )
    # Exploding the one text makes it a column of its own: a filter on it would
    # otherwise be pushed down and build the text a second time.
    others = [name for name in built.columns if name != "raw"]
    return built.select(*others, F.explode(F.array(raw)).alias("raw"))
