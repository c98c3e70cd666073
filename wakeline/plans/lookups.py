"""Result tables kept for looking rows up without reading them whole.

A table is written once in the order of its ids and once in that of its flights, in small
row groups. The least and greatest value of every group, which Parquet keeps, and a bloom
filter of its ids or flights leave few groups to read for an id, a prefix or a flight.
Rows are dealt by ranges of the key and their position, so a flight that fills much of the
table is spread over several files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 8 << 20
KEYS = ("event_id", "flight_id")


def save_lookups(
    rows: DataFrame, path: str, position: Sequence[str], row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write ``rows`` below ``path``, once for each key; ``position`` tells equal keys apart."""
    for key in KEYS:
        (
            rows.repartitionByRange(key, *position)
            .sortWithinPartitions(key, *position)
            .write.option("compression", "zstd")
            .option("parquet.block.size", row_group_bytes)
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .parquet(f"{path}/by_{key}")
        )


@dataclass(frozen=True)
class Lookups:
    """Look-ups over what :func:`save_lookups` wrote."""

    spark: SparkSession
    path: str

    def _by(self, key: str, wanted: Column) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/by_{key}").where(wanted)

    def ids(self, *event_ids: str) -> DataFrame:
        return self._by("event_id", F.col("event_id").isin(*event_ids))

    def prefixes(self, *id_prefixes: str) -> DataFrame:
        """Rows whose id begins with one of the prefixes, taken as they are."""
        wanted = F.lit(False)
        for prefix in id_prefixes:
            wanted = wanted | F.col("event_id").startswith(prefix)
        return self._by("event_id", wanted)

    def flight(self, flight_id: str) -> DataFrame:
        return self._by("flight_id", F.col("flight_id") == flight_id)

    def run(self, flight_id: str, id_prefixes: Sequence[str]) -> DataFrame:
        """Rows of a flight, and rows of any flight whose id begins with a prefix."""
        own = F.coalesce(F.col("flight_id") == flight_id, F.lit(False))
        return self.flight(flight_id).unionByName(self.prefixes(*id_prefixes).where(~own))
