"""Mixing sources to target weights, in blocks that are found by index.

Native: DataFrame functions only. The documents of a source, in a hash order, form one
stream of words that is cut into blocks of BLOCK words (the last one is shorter). A mix
is a number of slots, SHARD_SLOTS to an output shard, and each slot holds one block.

* A source gets as many slots as its target needs. The sources of a shard are drawn from
  all slots without putting back, by a keyed permutation: their counts are multinomial
  draws given the totals, so no shard is planned by hand, yet each source meets its target.
* Counts become index ranges: a shard's slots of a source follow those of earlier shards.
* The j-th slot of a source reads block ``perm(j mod blocks)``, where every pass over
  the source has a permutation of its own. A block is read again only after all others.
* Slots are joined to the documents in their block by (source, block), and what a document
  gives to the mix is summed over that join.

Null sources are one source, sorted last. Null and empty texts have no words and are
never taken. Repeated rows are documents of their own. Without any words, or rows, all
targets and takings are 0. Targets are computed over one row a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.tables import permuted
from wakeline.sources.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK = 64
SHARD_SLOTS = 4096
CHUNK_ROWS = 50_000
PIECE = 1 << 13
SHARD_CHUNK = 1 << 10


@dataclass
class Mix:
    """One row a document, a source, a document's part of a block, a draw, and a block read."""

    sizes: DataFrame
    sources: DataFrame
    parts: DataFrame
    counts: DataFrame
    slots: DataFrame


def targets(sizes: DataFrame) -> DataFrame:
    """Words of each source and in the mix: weights in code-point order, at most 3 times the size.

    Sources reach their limit in order of limit over weight; the level at which the
    next one stays below its limit is that of all that follow.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank - 1) % len(WEIGHTS) + 1)
    limit = F.col("source_size") * float(MOST_REPEATS)
    known = totals.withColumn("weight", weight).withColumn("limit", limit)
    every = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda name: F.coalesce(F.sum(name).over(before), F.lit(0.0))
    total = F.sum("source_size").over(every)
    level = (total - earlier("limit")) / (F.sum("weight").over(every) - earlier("weight"))
    held = known.withColumn("total", total).withColumn(
        "held", F.col("limit") / F.col("weight") <= level
    )
    of = lambda name, on: F.coalesce(F.sum(F.when(on, F.col(name))).over(every), F.lit(0.0))
    rest = (F.col("total") - of("limit", F.col("held"))) / of("weight", ~F.col("held"))
    return held.withColumn(
        "target", F.when(F.col("held"), F.col("limit")).otherwise(F.col("weight") * rest)
    ).select("source", "source_size", "target")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _starts(sizes: DataFrame, chunk_rows: int) -> DataFrame:
    """Where each document's words start in its source's stream, by chunks of documents."""
    used = sizes.filter("size > 0")
    chunks = max(1, -(-used.count() // chunk_rows))
    chunked = used.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)))
    before = (
        Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        chunked.groupBy("source", "_chunk")
        .agg(F.sum("size").alias("_total"))
        .select(
            F.col("source").alias("_of"),
            F.col("_chunk").alias("_at"),
            F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"),
        )
    )
    within = (
        Window.partitionBy("source", "_chunk")
        .orderBy("doc_id", "size", "_order")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.withColumn("_first", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(carry, _same("source", "_of") & (F.col("_chunk") == F.col("_at")))
        .select("_order", "source", "size", (F.col("_carry") + F.col("_first")).alias("start"))
    )


def mix(
    documents: DataFrame,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 11,
    chunk_rows: int = CHUNK_ROWS,
    order: Column | None = None,
) -> Mix:
    """Plan a mix of ``documents`` (doc_id, text, source) with as many words as they have.

    ``order`` is a unique number of each row, if they have one.
    """
    own = F.monotonically_increasing_id() if order is None else order
    sizes = staged(
        documents.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            own.alias("_order"),
        ),
        "words",
    )
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.when(
        F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("blocks"))
    ).otherwise(0)
    place = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    sources = staged(
        targets(sizes)
        .withColumn("blocks", blocks)
        .withColumn("slots", wanted.cast("long"))
        .withColumn("before", F.coalesce(F.sum("slots").over(place), F.lit(0)))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy())),
        "sources",
    )
    all_slots = sources.agg(F.max("all_slots")).first()[0] or 0
    counts = staged(_drawn(sources, all_slots, shard_slots, seed), "draws")
    slots = _slots(counts, sources, all_slots, seed)
    starts = _starts(sizes, chunk_rows)
    parts = starts.withColumn(
        "block",
        F.explode(F.expr(f"sequence(start DIV {block}, (start + size - 1) DIV {block})")),
    ).select(
        "_order",
        "source",
        "block",
        F.expr(f"greatest(0L, block * {block} - start)").alias("first_word"),
        F.expr(
            f"least(start + size, (block + 1) * {block}) - greatest(start, block * {block})"
        ).alias("words"),
    )
    return Mix(sizes, sources, parts, counts, slots)


def _tasks(all_slots: int) -> int:
    """Tasks for work on every slot; a number that is named is not made smaller later."""
    return max(1, min(-(-all_slots // (4 * PIECE)), 1 << 16))


def _drawn(sources: DataFrame, all_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """Slots of each source in each shard, where there are any: shard, source, n."""
    # A source's slots are counted out in pieces, so that no task holds all of a large one.
    pieces = (
        sources.filter("slots > 0")
        .withColumn("_piece", F.explode(F.expr(f"sequence(0L, (slots - 1) DIV {PIECE})")))
        .repartition(_tasks(all_slots), F.col("source"), F.col("_piece"))
    )
    draw = F.explode(F.expr(f"sequence(_piece * {PIECE}L, least(slots, (_piece + 1) * {PIECE}L) - 1)"))
    place = permuted(F.col("before") + F.col("draw"), F.col("all_slots"), F.lit(seed).cast("long"))
    return (
        pieces.withColumn("draw", draw)
        .withColumn("_place", place)
        .groupBy(F.expr(f"_place DIV {shard_slots}").alias("shard"), "source")
        .agg(F.count("*").alias("n"))
    )


def _slots(counts: DataFrame, sources: DataFrame, all_slots: int, seed: int) -> DataFrame:
    """The block that each slot reads: shard, slot, source, block.

    Earlier shards are summed in chunks of SHARD_CHUNK, so no window holds more of them.
    """
    chunked = counts.withColumn("_chunk", F.expr(f"shard DIV {SHARD_CHUNK}"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda name, w: F.coalesce(F.sum(name).over(before(w)), F.lit(0))
    carry = (
        chunked.groupBy("source", "_chunk")
        .agg(F.sum("n").alias("_n"))
        .select(
            F.col("source").alias("_of"),
            F.col("_chunk").alias("_at"),
            so_far("_n", Window.partitionBy("source").orderBy("_chunk")).alias("_carry"),
        )
    )
    placed = chunked.withColumns(
        {
            "_within": so_far("n", Window.partitionBy("source", "_chunk").orderBy("shard")),
            "_first": so_far("n", Window.partitionBy("shard").orderBy(F.col("source").asc_nulls_last())),
        }
    )
    ranges = placed.join(carry, _same("source", "_of") & (F.col("_chunk") == F.col("_at"))).select(
        "shard", "source", "n", "_first", (F.col("_carry") + F.col("_within")).alias("_index")
    )
    blocks = sources.select(F.col("source").alias("_of"), "blocks")
    key = F.xxhash64("source", F.expr("_j DIV blocks"), F.lit(seed))
    return (
        ranges.join(blocks, _same("source", "_of"))
        .repartition(_tasks(all_slots), "shard", "source")
        .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("_j", F.col("_index") + F.col("_k"))
        .select(
            "shard",
            (F.col("_first") + F.col("_k")).alias("slot"),
            "source",
            permuted(F.col("_j") % F.col("blocks"), F.col("blocks"), key).alias("block"),
        )
    )


def contents(plan: Mix) -> DataFrame:
    """The mix itself: for every slot the pieces of documents in its block."""
    parts = plan.parts.select(
        F.col("source").alias("_of"),
        F.col("block").alias("_at"),
        "_order",
        "first_word",
        "words",
    )
    # Null-safe on the block as well: a test for null would compute the permutation again.
    # Sizes behind an explode are guessed too low for Spark to choose this join itself.
    return plan.slots.hint("merge").join(parts, _same("source", "_of") & _same("block", "_at")).drop(
        "_of", "_at"
    )


def _read(plan: Mix) -> DataFrame:
    """Per document of which words are read: _order and taken, their number."""
    return contents(plan).groupBy("_order").agg(F.sum("words").alias("taken"))


def copies(plan: Mix, chunk_rows: int = CHUNK_ROWS, seed: int = 11) -> DataFrame:
    """Whole copies of each document, without bias: _order and times, where that is not 0.

    A document is drawn ``taken / size`` times on average: the whole part always, and the
    fractions, summed from a keyed start over a source's documents by size, once at every
    whole number they pass. The words drawn of a source differ from those taken by less
    than its longest document (in every chunk of about ``chunk_rows`` documents).
    """
    chunks = max(1, -(-plan.sizes.filter("size > 0").count() // chunk_rows))
    one = 1 << 30
    within = (
        Window.partitionBy("source", "_chunk")
        .orderBy("size", F.xxhash64("doc_id", F.lit(seed)), "doc_id", "_order")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.xxhash64("source", "_chunk", F.lit(seed)).bitwiseAND(one - 1)
    return (
        plan.sizes.join(_read(plan), "_order")
        .withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)))
        .withColumn("_part", F.expr(f"(taken % size) * {one}L DIV size"))
        .withColumn("_sum", F.sum("_part").over(within) + start)
        .withColumn(
            "times", F.expr(f"taken DIV size + _sum DIV {one}L - (_sum - _part) DIV {one}L").cast("int")
        )
        .filter("times > 0")
        .select("_order", "times")
    )


def taken(plan: Mix) -> DataFrame:
    """Per document: size, source_size, target, and taken, the words that the mix reads of it."""
    words = _read(plan)
    sources = plan.sources.select(F.col("source").alias("_of"), "source_size", "target")
    return (
        plan.sizes.join(words, "_order", "left")
        .join(sources, _same("source", "_of"))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
