"""Reproducible shuffle: a Feistel permutation over global row numbers.

Native: DataFrame functions only. Rows are numbered from 0 in an order that depends
on their values alone, the numbers are permuted by :func:`tables.permuted`, and shard
and slot follow by division, so that any row's place can be computed without
shuffling the others. Shard sizes differ by one row at most.

Null ids and texts are values like others; equal rows get different numbers, and
which of them gets which makes no difference. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.tables import permuted
from wakeline.sources.staging import staged

CHUNK_ROWS = 50_000
SALTS = 1024
COPIES = 1 << 16


def numbered(rows: DataFrame, by: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_row``, a gapless number from 0, to narrow rows; ``by`` are all their columns.

    Equal rows are counted before they are shuffled. Distinct rows go to chunks of
    about ``chunk_rows`` by a hash of their values; a chunk starts where the earlier
    ones end. The window over chunks sees one row for each chunk.
    """
    by = list(by)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    counted = rows.withColumn("_salt", salt).groupBy(*by, "_salt").agg(F.count("*").alias("_copies"))
    chunks = max(1, -(-rows.count() // chunk_rows))
    held = staged(counted.withColumn("_chunk", F.pmod(F.xxhash64(*by), F.lit(chunks))), "chunks")
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        held.groupBy("_chunk")
        .agg(F.sum("_copies").alias("_total"))
        .select("_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    within = (
        Window.partitionBy("_chunk")
        .orderBy(*by, "_salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = held.withColumn("_first", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
    pieces = first.join(starts, "_chunk").withColumn(
        "_piece", F.explode(F.expr(f"sequence(0L, (_copies - 1) DIV {COPIES})"))
    )
    copy = F.explode(
        F.expr(f"sequence(_piece * {COPIES}L, least(_copies, (_piece + 1) * {COPIES}L) - 1)")
    )
    return pieces.withColumn("_copy", copy).select(
        *by, (F.col("_start") + F.col("_first") + F.col("_copy")).alias("_row")
    )


def shard_rows(
    rows: DataFrame, by: Sequence[str], shards: int, seed: int = 7, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0) to narrow rows."""
    total = rows.count()
    at = permuted(F.col("_row"), F.lit(max(total, 1)).cast("long"), F.lit(seed).cast("long"))
    return (
        numbered(rows, by, chunk_rows)
        .withColumn("_at", at)
        .select(
            *by,
            (F.col("_at") % shards).cast("int").alias("shard"),
            F.expr(f"_at DIV {shards}").alias("slot"),
        )
    )


def shard_documents(documents: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """Place every document; size is its text's UTF-8 bytes plus 1 (null text: 1)."""
    text = F.coalesce("text", F.lit(""))
    narrow = staged(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ),
        "sizes",
    )
    return shard_rows(narrow, ["doc_id", "size", "text_crc32"], shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(rows: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """Write rows that have ``shard`` and ``slot`` as one folder a shard, files in slot order."""
    piece = F.expr(f"slot DIV {per_file}")
    (
        rows.repartition("shard", piece)
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
