"""One-minute aggregate: final per-minute rows and mergeable partial rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.schema import MINUTE
from wakeline.settings import Rules

GROUP = ("aircraft_id", "flight_id", "window_start", "window_end")

# Output column -> aggregate and sensor, in table order.
MEASURES = {
    "avg_ground_speed_kts": ("avg", "ground_speed_kts"),
    "max_ground_speed_kts": ("max", "ground_speed_kts"),
    "avg_altitude_ft": ("avg", "altitude_ft"),
    "max_altitude_ft": ("max", "altitude_ft"),
    "avg_engine_temp_c": ("avg", "engine_temp_c"),
    "max_engine_temp_c": ("max", "engine_temp_c"),
    "avg_fuel_flow_kg_h": ("avg", "fuel_flow_kg_h"),
    "min_fuel_remaining_kg": ("min", "fuel_remaining_kg"),
    "max_fuel_remaining_kg": ("max", "fuel_remaining_kg"),
}

_AGG = {"avg": F.avg, "max": F.max, "min": F.min}


def minute_end(rules: Rules = Rules()) -> Column:
    return F.window("event_time", rules.minute)["end"]


def counted(watermark: Column, rules: Rules = Rules()) -> Column:
    """True while the row's minute is still open when the row arrives."""
    return F.coalesce(minute_end(rules) > watermark, F.lit(True))


def _grouped(df: DataFrame, rules: Rules) -> DataFrame:
    span = F.window("event_time", rules.minute)
    return df.withColumns({"window_start": span["start"], "window_end": span["end"]})


def minute_aggregate(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Aggregate accepted rows that entered their minute while it was open."""
    return (
        _grouped(rows, rules)
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            *[_AGG[kind](sensor).alias(name) for name, (kind, sensor) in MEASURES.items()],
            F.count_if("late").alias("late_count"),
        )
        .select(*MINUTE.fieldNames())
    )


def partial_minutes(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per-minute parts that can be merged with the parts of other batches."""
    averaged = [sensor for kind, sensor in MEASURES.values() if kind == "avg"]
    return (
        _grouped(rows, rules)
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if("late").alias("late_count"),
            *[F.sum(sensor).alias(f"sum_{sensor}") for sensor in averaged],
            *[F.count(sensor).alias(f"n_{sensor}") for sensor in averaged],
            *[
                _AGG[kind](sensor).alias(name)
                for name, (kind, sensor) in MEASURES.items()
                if kind != "avg"
            ],
        )
    )


def merge_partials(parts: DataFrame) -> DataFrame:
    summed = [c for c in parts.columns if c.startswith(("sum_", "n_")) or c.endswith("_count")]
    return parts.groupBy(*GROUP).agg(
        *[F.sum(name).alias(name) for name in summed],
        *[
            _AGG[kind](name).alias(name)
            for name, (kind, _) in MEASURES.items()
            if kind != "avg"
        ],
    )


def finish_partials(parts: DataFrame) -> DataFrame:
    """Minute rows of merged parts."""
    averages = {
        name: F.try_divide(F.col(f"sum_{sensor}"), F.col(f"n_{sensor}"))
        for name, (kind, sensor) in MEASURES.items()
        if kind == "avg"
    }
    return parts.withColumns(averages).select(*MINUTE.fieldNames())
