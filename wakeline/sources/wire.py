"""The JSON wire format: decoding messages and building them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timetext import iso_ms, parse_iso
from wakeline.schema import EVENT, SENSORS

PAYLOAD = EVENT.fieldNames()
# Every field is taken as text first, so that one odd field cannot spoil another.
TEXTS = ", ".join(f"{name} STRING" for name in PAYLOAD)


def _typed(name: str) -> Column:
    text = F.col(f"_event.{name}")
    if name == "event_time":
        return parse_iso(text).alias(name)
    return (text.try_cast("double") if name in SENSORS else text).alias(name)


def parse(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Replace ``raw`` by the payload columns and ``is_object``.

    In a JSON object a missing field becomes NULL, and so does a time that is no
    ISO-8601 text in UTC and a sensor that is no number. Numbers may come as text.
    """
    others = [name for name in df.columns if name != raw]
    event = F.from_json(raw, TEXTS, {"mode": "PERMISSIVE"})
    return df.select(
        *others, event.alias("_event"), F.json_object_keys(raw).isNotNull().alias("is_object")
    ).select(*others, *[_typed(name) for name in PAYLOAD], "is_object")


def decode(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Payload columns of the messages; text that is no JSON object is skipped.

    Rows with missing fields stay: the rules reject them by reason.
    """
    return parse(df.where(F.json_object_keys(raw).isNotNull()), raw).drop("is_object")


def iso_payload() -> Column:
    """Payload columns as one JSON text; NULL fields are written out."""
    fields = [
        iso_ms(F.col(name)).alias(name) if name == "event_time" else F.col(name)
        for name in PAYLOAD
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def publish_records(rows: DataFrame) -> DataFrame:
    """``key`` and ``value`` of the message of each row, keyed by aircraft."""
    return rows.select(F.col("aircraft_id").alias("key"), iso_payload().alias("value"))
