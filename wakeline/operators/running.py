"""Running aggregates over one global arrival order, without a one-task window.

Rows are cut into buckets of ``width`` consecutive positions of a unique integer
order, so a bucket never holds more than ``width`` rows whatever the data looks
like. Each bucket is scanned by its own task; what came before the bucket is
carried in from a small table of bucket totals, and the bucket totals are summed
up the same way one level higher.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET_ROWS = 1 << 17
FAN_OUT = 1 << 12
# With one level of groups, 10^13 positions leave 20,000 rows for the last window.
LEVELS = 1

_FOLD = {"max": F.max, "min": F.min, "sum": F.sum}


def _join_two(kind: str, before: Column, here: Column) -> Column:
    if kind == "max":
        return F.greatest(before, here)
    if kind == "min":
        return F.least(before, here)
    return F.coalesce(before + here, before, here)


def _bucket_of(position: str, size: int) -> Column:
    return F.expr(f"`{position}` DIV {size}")


def _fold_rows(kinds: Mapping[str, str]) -> list[Column]:
    return [_FOLD[kind](name).alias(name) for name, kind in kinds.items()]


def _running_rows(kinds: Mapping[str, str], window: WindowSpec) -> dict[str, Column]:
    return {name: _FOLD[kind](name).over(window) for name, kind in kinds.items()}


def _add_carry(
    df: DataFrame, carry: DataFrame, keys: list[str], bucket: str, kinds: Mapping[str, str]
) -> DataFrame:
    """Combine values within a bucket with what the earlier buckets hold.

    The rows come sorted and partitioned from their window, which serves this
    join too. It is a left join only so that both readers of a bucket table stay
    alike and share one shuffle; every bucket has a carry row.
    """
    before = carry.select(
        *keys,
        F.col("_bucket").alias(bucket),
        *[F.col(name).alias(f"_before_{name}") for name in kinds],
    )
    combined = {
        name: _join_two(kind, F.col(f"_before_{name}"), F.col(name))
        for name, kind in kinds.items()
    }
    return (
        df.join(before, [*keys, bucket], "left")
        .withColumns(combined)
        .drop(*[f"_before_{name}" for name in kinds])
    )


def _carries(totals: DataFrame, keys: list[str], kinds: Mapping[str, str], levels: int):
    """For every bucket, the aggregate of all earlier buckets."""
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    if levels == 0:
        return totals.withColumns(_running_rows(kinds, earlier.partitionBy(*keys)))
    grouped = totals.withColumn("_group", _bucket_of("_bucket", FAN_OUT))
    group_totals = grouped.groupBy(*keys, F.col("_group").alias("_bucket")).agg(
        *_fold_rows(kinds)
    )
    above = _carries(group_totals, keys, kinds, levels - 1)
    within = grouped.withColumns(_running_rows(kinds, earlier.partitionBy(*keys, "_group")))
    return _add_carry(within, above, keys, "_group", kinds).drop("_group")


def running(
    df: DataFrame,
    order: str,
    values: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    include_current: bool = True,
    width: int = BUCKET_ROWS,
) -> DataFrame:
    """Add running aggregates of ``values`` in the order of ``order``.

    ``values`` maps a new column to ``(kind, expression)`` with kind ``max``,
    ``min`` or ``sum``. ``order`` must be a unique integer; ``keys`` must not be
    NULL. With ``include_current=False`` a row sees only the rows before it.
    """
    keys = list(keys)
    kinds = {name: kind for name, (kind, _) in values.items()}
    totals = df.groupBy(*keys, _bucket_of(order, width).alias("_bucket")).agg(
        *[_FOLD[kind](expr).alias(name) for name, (kind, expr) in values.items()]
    )
    window = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    within = df.withColumn("_bucket", _bucket_of(order, width)).withColumns(
        {name: _FOLD[kind](expr).over(window) for name, (kind, expr) in values.items()}
    )
    return _add_carry(within, _carries(totals, keys, kinds, LEVELS), keys, "_bucket", kinds).drop(
        "_bucket"
    )
