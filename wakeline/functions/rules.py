"""Quality rules as Column expressions, shared by batch replay and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.settings import Rules, seconds

# Reject reasons, in the order they appear in a joined reason.
BLANK_EVENT_ID = "blank_event_id"
MISSING_AIRCRAFT = "missing_aircraft_id"
MISSING_FLIGHT = "missing_flight_id"
MISSING_TIME = "missing_event_time"
MISSING_TEMP = "missing_engine_temp"
TOO_LATE = "too_late"
DUPLICATE = "duplicate"


def blank(name: str) -> Column:
    """NULL, empty or only spaces."""
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def overheat(rules: Rules = Rules()) -> Column:
    """Strictly above the limit. NaN, which Spark sorts above all numbers, is not."""
    temp = F.col("engine_temp_c")
    return F.coalesce((temp > F.lit(rules.temp_limit_c)) & ~F.isnan(temp), F.lit(False))


def late(watermark: Column) -> Column:
    """Strictly behind the watermark; unknown time or watermark is not late."""
    return F.coalesce(F.col("event_time") < watermark, F.lit(False))


def too_late(watermark: Column, rules: Rules = Rules()) -> Column:
    return F.coalesce(
        F.col("event_time") < watermark - seconds(rules.lateness_s), F.lit(False)
    )


def field_defects() -> Column:
    """Defects a row shows by itself, joined with commas; NULL for none."""
    defects = (
        (blank("event_id"), BLANK_EVENT_ID),
        (blank("aircraft_id"), MISSING_AIRCRAFT),
        (blank("flight_id"), MISSING_FLIGHT),
        (F.col("event_time").isNull(), MISSING_TIME),
        (F.col("engine_temp_c").isNull(), MISSING_TEMP),
    )
    named = [F.when(test, F.lit(reason)) for test, reason in defects]
    return F.nullif(F.concat_ws(",", *named), F.lit(""))


def reject_reason(
    watermark: Column, rules: Rules = Rules(), defects: Column | None = None
) -> Column:
    """All defects of a row, lateness last; NULL for a row without any.

    ``defects`` takes the place of :func:`field_defects` where that is already known.
    """
    own = field_defects() if defects is None else defects
    behind = F.when(too_late(watermark, rules), F.lit(TOO_LATE))
    return F.nullif(F.concat_ws(",", own, behind), F.lit(""))


def lateness_class(watermark: Column, rules: Rules = Rules()) -> Column:
    """on_time, out_of_order, late or too_late.

    Out of order means behind the newest event seen but not behind the
    watermark, which trails that event by the out-of-order bound.
    """
    newest = watermark + seconds(rules.out_of_order_s)
    return (
        F.when(too_late(watermark, rules), TOO_LATE)
        .when(late(watermark), "late")
        .when(F.col("event_time") < newest, "out_of_order")
        .when(F.col("event_time").isNotNull(), "on_time")
    )


def tag(
    df: DataFrame, watermark: Column, rules: Rules = Rules(), defects: Column | None = None
) -> DataFrame:
    """Add ``overheat``, ``late`` and ``reject_reason``; no row is dropped."""
    return df.withColumns(
        {
            "overheat": overheat(rules),
            "late": late(watermark),
            "reject_reason": reject_reason(watermark, rules, defects),
        }
    )
