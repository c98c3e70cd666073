"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask looks at some and ignores the rest, so
that a seed still matches where words were substituted at ignored places. Long items use
wide, heavy masks, shorter ones narrow and light ones (``masks_of``). Seeds of items and
of training texts are joined by their hash; a hit lays the item over the text at one
shift, and each such pair is verified word by word. It is an overlap if

* the best stretch, in which a substitution costs PENALTY equal words, holds LEAST_WORDS
  equal words and scores LEAST_SCORE, or
* of an item of at least TOLERANT words, the share SHARE is equal at that shift, or
* all words of a shorter item are equal. Items of fewer than LEAST_ITEM words say too
  little inside a text: they match only a text that consists of them.

Texts stream past a bitmap of the items' seeds (at most 32 MB, its size follows the seeds),
and only seeds in it are joined. Texts are known by a hash of theirs, so copies are looked
at once; of the texts themselves only those with a hit are shuffled, to be verified.

Null and empty texts and items match nothing. Repeated training rows are reported each;
repeated items once for each row. Words are runs without white space, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.folding import Bitmap, bitmap
from wakeline.llm.memory import releasing
from wakeline.llm.words import mix, words
from wakeline.sources.staging import staged

LIGHT = ("1111", "11011")
MIDDLE = ("11111", "110111", "1011011")
MASKS = ("1101101011", "1011011101", "1110010111", "1101110011")
SPAN = len(MASKS[0])
LEAST_ITEM, TOLERANT, MEDIUM, LONG = 5, 8, 12, 32
SHARE = 0.8
LEAST_WORDS = 13
PENALTY = 3
LEAST_SCORE = 8
# Items found in one text are verified in so many parts, each a row.
PARTS = 8

_MASKS = (*MASKS, *MIDDLE, *LIGHT, *("1" * n for n in range(1, TOLERANT)))
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_FOUND = "item_id long, doc_first long, doc_end long, item_first long, item_end long, equal_words long, score long"
SCHEMA = f"doc_id long, {_FOUND}"


def masks_of(size: int) -> tuple[str, ...]:
    """The masks for an item of ``size`` words; an item of few words is a seed as a whole."""
    if size >= LONG:
        return MASKS
    if size >= MEDIUM:
        return MIDDLE
    if size >= TOLERANT:
        return LIGHT
    return ("1" * size,) if size else ()


def _keys(hashes: np.ndarray, mask: str, whole: bool = False) -> np.ndarray:
    """One value for each window as long as the mask, over the places it looks at."""
    count = max(len(hashes) - len(mask) + 1, 0)
    total = np.full(count, 2 * _MASKS.index(mask) + whole, np.uint64)
    for k, look in enumerate(mask):
        if look == "1" and count:
            total += hashes[k : k + count] * _PLACES[k]
    return mix(total)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of items: key, item, place."""
    for batch in batches:
        owners, keys, places = [], [], []
        items = np.array(batch.column(0))
        for row, data in enumerate(batch.column(1).to_pylist()):
            own = np.frombuffer(data, np.uint64)
            for mask in masks_of(len(own)):
                found = _keys(own, mask, len(own) < LEAST_ITEM)
                owners.append(np.full(len(found), items[row]))
                keys.append(found)
                places.append(np.arange(len(found)))
        if keys:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.concatenate(owners)),
                    pa.array(np.concatenate(places)),
                ],
                ["key", "item", "at_item"],
            )


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            found.hashes[a:b].tobytes()
            for found in words(batch.column(2))
            for a, b in zip(found.bounds, found.bounds[1:], strict=False)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["item", "item_id", "words"]
        )


def _hits(known: Bitmap, masks: list[str], whole: list[int]):
    """Seeds of texts that the bitmap of items' seeds holds, of each text in a batch once."""

    @releasing
    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(0))
            _, once = np.unique(keys, return_index=True)
            batch, keys = batch.take(pa.array(np.sort(once))), keys[np.sort(once)]
            for found in words(batch.column(1)):
                sizes = np.diff(found.bounds)
                row = np.repeat(np.arange(len(sizes)), sizes)
                for mask in masks:
                    seeds = _keys(found.hashes, mask)
                    last = row[len(mask) - 1 :]
                    at = np.flatnonzero(known.holds(seeds) & (row[: len(seeds)] == last))
                    if len(at):
                        yield _hit_rows(keys[found.first_row + row[at]], seeds[at], at - found.bounds[row[at]])
                for size in whole:
                    own = np.flatnonzero(sizes == size)
                    seeds = _keys(found.hashes, "1" * size, True)[found.bounds[own]] if len(own) else own
                    at = own[known.holds(seeds)] if len(own) else own
                    if len(at):
                        seeds = seeds[known.holds(seeds)]
                        yield _hit_rows(keys[found.first_row + at], seeds, np.zeros(len(at), np.int64))

    return hit


def _hit_rows(texts: np.ndarray, seeds: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(seeds.view(np.int64)), pa.array(places)], ["text_key", "key", "at_text"]
    )


def verified(text: np.ndarray, own: np.ndarray, shift: int) -> tuple | None:
    """What an item, laid over a text at ``shift``, has in common with it, if that is enough."""
    first, end = max(0, -shift), min(len(own), len(text) - shift)
    same = text[first + shift : end + shift] == own[first:end]
    if len(own) < LEAST_ITEM and len(text) != len(own):
        return None
    if not len(same):
        return None
    sums = np.concatenate(([0], np.cumsum(np.where(same, 1, -PENALTY))))
    lowest = np.minimum.accumulate(sums)
    stop = int(np.argmax(sums - lowest))
    start = int(np.flatnonzero(sums[: stop + 1] == lowest[stop])[-1])
    equal, score = int(same[start:stop].sum()), int(sums[stop] - lowest[stop])
    if equal < LEAST_WORDS or score < LEAST_SCORE:
        start, stop, equal = 0, len(same), int(same.sum())
        score = equal - PENALTY * (stop - equal)
        if equal < (SHARE * len(own) if len(own) >= TOLERANT else len(own)):
            return None
    at = first + start
    return at + shift, at + shift + stop - start, at, at + stop - start, equal, score


_STRETCH = "text_key long, " + _FOUND


@releasing
def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text and item the best overlap."""
    names = [part.split()[0] for part in _STRETCH.split(", ")]
    for batch in batches:
        rows = []
        for found in words(batch.column(1)):
            for k, (a, b) in enumerate(zip(found.bounds, found.bounds[1:], strict=False)):
                text = found.hashes[a:b]
                key = batch.column(0)[found.first_row + k].as_py()
                best: dict[int, tuple] = {}
                for hit in batch.column(2)[found.first_row + k].as_py():
                    got = verified(text, np.frombuffer(hit["words"], np.uint64), hit["shift"])
                    if got and ((old := best.get(hit["item"])) is None or (got[4], got[5], -got[0]) > old[0]):
                        best[hit["item"]] = ((got[4], got[5], -got[0]), hit["item_id"], got)
                rows += [(key, item_id, *got) for _, item_id, got in best.values()]
        if rows:
            columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _text_key() -> Column:
    return F.xxhash64("text", F.length("text"))


def _in_bitmap(known: Bitmap, inside: bool):
    """Rows whose first column, a hash, the bitmap holds, or does not hold."""

    @releasing
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = known.holds(_spread(np.array(batch.column(0))))
            yield batch.filter(pa.array(held if inside else ~held))

    return pick


def _spread(keys: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64))


def _key_bitmap(texts: DataFrame) -> Bitmap:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _spread(np.array(batch.column(0))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])

    return bitmap(texts.select("text_key").mapInArrow(spread, "key long"))


def _sizes(items: DataFrame) -> list[int]:
    """The kinds of items there are, by the number of words: at most LONG different ones."""
    count = F.least(F.octet_length("words") / 8, F.lit(LONG)).cast("int")
    return [row.n for row in items.select(count.alias("n")).distinct().collect()]


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per distinct text and item that overlap, the best stretch; texts by ``text_key``."""
    items = staged(
        benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text").mapInArrow(
            _item_words, "item long, item_id long, words binary"
        ),
        "items",
    )
    sizes = _sizes(items)
    seeds = staged(items.select("item", "words").mapInArrow(_seeds, "key long, item long, at_item long"), "seeds")
    known = bitmap(seeds.select("key"))
    masks = sorted({mask for size in sizes if size >= LEAST_ITEM for mask in masks_of(size)})
    whole = sorted(size for size in sizes if 0 < size < LEAST_ITEM)
    texts = documents.filter("text is not null").select(_text_key().alias("text_key"), "text")
    shift = (F.col("at_text") - F.col("at_item")).alias("shift")
    laid = (
        texts.mapInArrow(_hits(known, masks, whole), "text_key long, key long, at_text long")
        .join(seeds, "key")
        .select("text_key", "item", shift)
        .distinct()
        .join(items, "item")
        .groupBy("text_key", F.pmod(F.xxhash64("item"), F.lit(PARTS)).alias("part"))
        .agg(F.collect_list(F.struct("item", "item_id", "shift", "words")).alias("hits"))
    )
    laid = staged(laid, "laid")
    hit_texts = (
        texts.mapInArrow(_in_bitmap(_key_bitmap(laid), True), "text_key long, text string")
        .groupBy("text_key")
        .agg(F.first("text").alias("text"))
    )
    return staged(
        hit_texts.join(laid, "text_key").select("text_key", "text", "hits").mapInArrow(_verifier, _STRETCH),
        "overlaps",
    )


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that overlap, with the best stretch.

    ``documents`` needs doc_id and text, ``benchmark`` item_id and text. Places count
    words from 0, ends exclusive.
    """
    found = overlaps(documents, benchmark)
    keyed = documents.filter("text is not null").select(F.col("doc_id").cast("long"), _text_key().alias("text_key"))
    return keyed.join(found, "text_key").drop("text_key")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text overlaps no item, all columns as they are.

    Rows are judged by their text alone, whatever ids they share. Only rows that a bitmap
    of the overlapping texts lets through are shuffled.
    """
    found = overlaps(documents, benchmark).select("text_key").distinct()
    known = _key_bitmap(found)
    keyed = documents.select(F.coalesce(_text_key(), F.lit(0)).alias("_text_key"), *documents.columns)
    apart = keyed.mapInArrow(_in_bitmap(known, False), keyed.schema)
    suspect = keyed.mapInArrow(_in_bitmap(known, True), keyed.schema)
    gone = found.select(F.col("text_key").alias("_text_key"), F.lit(True).alias("_leaks"))
    kept = suspect.join(gone, "_text_key", "left").filter(F.col("_leaks").isNull() | F.col("text").isNull())
    return apart.unionByName(kept.drop("_leaks")).drop("_text_key")
