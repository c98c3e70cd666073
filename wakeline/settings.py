"""Rule parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Limits of the quality rules. The defaults are the usual values."""

    out_of_order_s: float = 5
    lateness_s: float = 15
    temp_limit_c: float = 1000
    dedup_ttl_s: float = 3600
    idle_s: float = 10
    slice_ms: int = 200
    minute: str = "1 minute"


def seconds(value: float) -> Column:
    """A day-time interval of ``value`` seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(value))
