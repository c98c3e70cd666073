"""Column layouts of the event stream and the three result tables."""

from __future__ import annotations

from pyspark.sql import types as T

IDS = ("event_id", "aircraft_id", "flight_id")

SENSORS = (
    "latitude",
    "longitude",
    "altitude_ft",
    "ground_speed_kts",
    "vertical_speed_fpm",
    "heading_deg",
    "engine_temp_c",
    "oil_pressure_psi",
    "fuel_flow_kg_h",
    "fuel_remaining_kg",
    "outside_air_temp_c",
)

POSITION = ("kafka_partition", "kafka_offset", "kafka_timestamp")


def _fields(names: tuple[str, ...], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_POSITION_FIELDS = [
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
]

# Payload of one message on the wire.
EVENT = T.StructType(
    _fields(IDS, T.StringType())
    + [T.StructField("event_time", T.TimestampType())]
    + _fields(SENSORS, T.DoubleType())
)

# Payload plus where and when the message arrived.
ARRIVAL = T.StructType(
    EVENT.fields + _POSITION_FIELDS + [T.StructField("proc_time", T.TimestampType())]
)

_STORED = (
    _fields(IDS, T.StringType())
    + _fields(("event_time", "ingest_time"), T.TimestampType())
    + _fields(SENSORS, T.DoubleType())
)

DETAIL = T.StructType(_STORED + _fields(("overheat", "late"), T.BooleanType()))

REJECTED = T.StructType(
    _STORED + [T.StructField("reason", T.StringType())] + _POSITION_FIELDS
)

MINUTE = T.StructType(
    _fields(("aircraft_id", "flight_id"), T.StringType())
    + _fields(("window_start", "window_end"), T.TimestampType())
    + [T.StructField("event_count", T.LongType())]
    + _fields(
        (
            "avg_ground_speed_kts",
            "max_ground_speed_kts",
            "avg_altitude_ft",
            "max_altitude_ft",
            "avg_engine_temp_c",
            "max_engine_temp_c",
            "avg_fuel_flow_kg_h",
            "min_fuel_remaining_kg",
            "max_fuel_remaining_kg",
        ),
        T.DoubleType(),
    )
    + [T.StructField("late_count", T.LongType())]
)

# Message of a recorded topic: the columns a Kafka source delivers.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Reduced record of the JSON sink.
CLEAN_RECORD = (
    "event_id",
    "aircraft_id",
    "flight_id",
    "event_time",
    "ingest_time",
    "altitude_ft",
    "ground_speed_kts",
    "engine_temp_c",
    "fuel_remaining_kg",
    "overheat",
    "watermark",
    "late",
)
