"""One value from many tasks: each hands over a row of bounded size, merged level by level."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.staging import staged

FAN = 16
PART = "part long, data binary"


def per_task(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], bytes | None]) -> DataFrame:
    """One row (part, data) from each task for which ``work`` gives a value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = work(batch for batch in batches if batch.num_rows)
        if data is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([data], pa.binary())], ["part", "data"]
            )

    return rows.mapInArrow(run, PART)


def folded(parts: DataFrame, merge: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """Merge the rows of tasks in groups of FAN, level by level, in the order of tasks."""
    parts = staged(parts, name)
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return None

    def group(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        data = merge(table["data"].to_pylist())
        return pa.table(
            {"part": pa.array([table["part"][0].as_py() // FAN]), "data": pa.array([data], pa.binary())}
        )

    while most > 0:
        parts = parts.groupBy(F.expr(f"part div {FAN}")).applyInArrow(group, PART)
        most //= FAN
    return parts.first().data


def summed(kind) -> Callable[[list[bytes]], bytes]:
    """Merges arrays of one length by adding them."""
    return lambda rows: sum(np.frombuffer(row, kind) for row in rows).tobytes()


LEAST_BITS, MOST_BITS, BITS_EACH = 16, 28, 16


class Bitmap:
    """A set of 64-bit hashes as bits: what is in it is found, little else is.

    Its size follows the number of hashes, BITS_EACH bits for each, up to 2^MOST_BITS bits
    (32 MB); beyond that it lets more through.
    """

    def __init__(self, data: bytes, bits: int):
        self.data, self.bits = np.frombuffer(data, np.uint8), bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of one column of longs, which are well mixed hashes. Only it reaches the driver."""
    many = hashes.count()
    bits = min(max(LEAST_BITS, (many * BITS_EACH).bit_length()), MOST_BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        held = np.zeros(1 << (bits - 3), np.uint8)
        seen = False
        for batch in batches:
            at = np.array(batch.column(0)).view(np.uint64) >> np.uint64(64 - bits)
            np.bitwise_or.at(held, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            seen = True
        return held.tobytes() if seen else None

    def merge(rows: list[bytes]) -> bytes:
        return np.bitwise_or.reduce([np.frombuffer(row, np.uint8) for row in rows]).tobytes()

    data = folded(per_task(hashes, work), merge, "bitmap")
    return Bitmap(data if data is not None else bytes(1 << (bits - 3)), bits)
