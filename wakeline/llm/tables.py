"""Columns of the input tables, and permutations in plain SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table; any further columns are left behind."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


ROUNDS = 4
# A walk leaves the square's margin, under one row of it, with each step. Domains of
# up to 400 numbers end within this many steps; for larger ones the chance that a
# number is still outside is below 20^-20, and then the query fails.
WALKS = 20


def permuted(number: Column, size: Column, key: Column) -> Column:
    """Keyed permutation of 0 .. size-1 as a SQL expression: Feistel rounds, cycle walking.

    A number is a place in a rectangle of ``rows`` x ``columns`` just larger than
    ``size``. Each round moves the row by a hash of the column and the column by a
    hash of the row; what lands outside 0 .. size-1 goes round again. ``number``,
    ``size`` and ``key`` are long columns; sizes stay below 2^52.
    """
    rows = F.ceil(F.sqrt(size.cast("double"))).cast("long")
    columns = F.ceil(size / rows).cast("long")

    def step(place: Column) -> Column:
        def turn(state: Column, k: Column) -> Column:
            row = (state["row"] + F.pmod(F.xxhash64(state["column"], k, key), rows)) % rows
            column = state["column"] + F.pmod(F.xxhash64(row, key, k), columns)
            return F.struct(row.alias("row"), (column % columns).alias("column"))

        start = F.struct(
            F.floor(place / columns).cast("long").alias("row"),
            (place % columns).alias("column"),
        )
        return F.aggregate(
            F.array(*[F.lit(k) for k in range(ROUNDS)]),
            start,
            turn,
            lambda state: state["row"] * columns + state["column"],
        )

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        F.struct(number.alias("at"), F.lit(False).alias("home")),
        lambda state, _: F.when(state["home"], state).otherwise(
            F.transform(
                F.array(step(state["at"])),
                lambda at: F.struct(at.alias("at"), (at < size).alias("home")),
            )[0]
        ),
    )
    return F.when(walked["home"], walked["at"]).otherwise(
        F.raise_error(F.lit("the permutation's walk did not end")).cast("long")
    )
