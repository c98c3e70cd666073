"""Documents whose word n-gram sets have a Jaccard similarity of at least 0.75.

The join is cut vertically: the global order of n-grams (that of their 64-bit hashes) is
cut into FRAGMENTS ranges, a pair's overlap is counted in each range by itself, and the
counts are summed per pair. A fragment's count is left out, and with it the pair, when its
differences alone exceed what a similar pair may have in all.

What makes candidates few, without losing a link between different sets:

1. Equal sets are one class, represented once.
2. A class can only link if at least three quarters of its n-grams occur elsewhere. n-grams
   are dealt by ranges to tasks as packed places, and each range says which places are
   shared; most documents end here.
3. Stars: classes with the same least n-gram under some hash are compared to one of them,
   the hub. In further turns with other hubs only classes take part that step 4 would
   have to look at. That joins most large groups of copies with few links a member.
4. The rest exactly: only classes of which three quarters of the n-grams occur in other
   components can still link. They are joined by prefix, rarest n-grams first, across
   components only, and the new links are added to the components. Two bounds keep that
   join from giving out pairs that cannot link: the n-grams that either set shares with
   anything, and the bits in which the parities of both sets differ, of which a
   difference between the sets changes one at most.

A star or prefix never drops a pair because a group is large. Near copies that all lie
just below the threshold are still compared with each other inside that join. Result: class and component
of every document. Texts that are null or hold no word have an empty set and link with
nothing. Repeated rows are equal sets. Null ids count as larger than any id, so a
component's id is null only if all its ids are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.components import components
from wakeline.llm.memory import releasing
from wakeline.llm.words import mix, shingles, words
from wakeline.sources.staging import staged

WIDTH = 5
FRAGMENTS = 4
STARS = 8
TURNS = 6
BLOCK_GRAMS = 500_000
BLOCK_SETS = 65_000
RANGE_BYTES = 1 << 23
PARITY_WORDS = 16
_LOW = 24
_SHARED = 0xFFFF
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, STARS, dtype=np.uint64)


def similar(overlap: Column, left: Column, right: Column) -> Column:
    """100 * intersection >= 75 * union."""
    return 100 * overlap >= 75 * (left + right - overlap)


def gram_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every row."""
    for found in words(texts):
        grams, bounds = shingles(found, width)
        for first, last in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            own = np.sort(grams[first:last])
            yield own if len(own) < 2 else own[np.concatenate(([True], own[1:] != own[:-1]))]


# -- Step 2: how many of a set's n-grams occur under another label ------------------------


def _packed(low: np.ndarray, places: np.ndarray) -> bytes:
    """Ascending numbers as differences, and a place for each."""
    steps = np.diff(low, prepend=low[:1] * 0)
    kind = "<u2" if steps.max(initial=0) < 1 << 16 else "<u4"
    return bytes([int(kind[2])]) + steps.astype(kind).tobytes() + places.astype("<u2").tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = data[0]
    count = (len(data) - 1) // (width + 2)
    steps = np.frombuffer(data, f"<u{width}", count, 1)
    return np.cumsum(steps, dtype=np.uint32), np.frombuffer(data, "<u2", count, 1 + width * count)


_DEALT = "range long, block long, data binary"


class _Block:
    """Sets of one task that are dealt to the ranges together."""

    def __init__(self, bits: int):
        self.bits = bits
        self.sets: list[np.ndarray] = []
        self.labels: list[int] = []
        self.rows: list[bytes] = []
        self.size = 0

    def add(self, grams: np.ndarray, label: int, row: bytes) -> None:
        self.sets.append(grams)
        self.labels.append(label)
        self.rows.append(row)
        self.size += len(grams)

    def full(self) -> bool:
        return self.size >= BLOCK_GRAMS or len(self.sets) >= BLOCK_SETS

    def dealt(self, block: int) -> pa.RecordBatch:
        sizes = [len(x) for x in self.sets]
        key = np.concatenate(self.sets) >> np.uint64(64 - self.bits - _LOW)
        both = np.sort(key << np.uint64(16) | np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64))
        key, place = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.int64)
        label = np.array(self.labels, np.int64)[place]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else place
        low, high = (f.reduceat(label, first) if len(key) else label for f in (np.minimum, np.maximum))
        mixed = low != high
        inside = np.repeat(mixed, np.diff(np.append(first, len(key))))
        own = np.bincount(place[inside], minlength=len(sizes)).astype("<u4")
        # An n-gram under several labels here is shared; the ranges only hear of it once.
        kept = ~inside
        kept[first[mixed]] = True
        place[first[mixed]] = _SHARED
        key, place = key[kept], place[kept]
        bounds = np.searchsorted(key >> np.uint64(_LOW), np.arange((1 << self.bits) + 1).astype(np.uint64))
        ranges = np.flatnonzero(np.diff(bounds))
        low = (key & np.uint64((1 << _LOW) - 1)).astype(np.uint32)
        data = [_packed(low[bounds[r] : bounds[r + 1]], place[bounds[r] : bounds[r + 1]]) for r in ranges]
        lengths = np.array([len(x) for x in self.rows], "<u4").tobytes()
        directory = np.uint32(len(sizes)).tobytes() + own.tobytes() + lengths + b"".join(self.rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*ranges.tolist(), (1 << self.bits) + block], pa.int64()),
                pa.array([block] * (len(ranges) + 1), pa.int64()),
                pa.array([*data, directory], pa.binary()),
            ],
            ["range", "block", "data"],
        )


def _sharer(bits: int):
    def shared(table: pa.Table) -> pa.Table:
        """Places of n-grams that another block or label has too, by block."""
        if table["range"][0].as_py() >= 1 << bits:
            return table.select(["block", "data"]).append_column("kind", pa.array([1] * len(table)))
        parts = [_unpacked(x.as_py()) for x in table["data"]]
        key = np.concatenate([x for x, _ in parts])
        place = np.concatenate([x for _, x in parts])
        row = np.repeat(np.arange(len(parts)), [len(x) for x, _ in parts])
        order = np.argsort(key, kind="stable")
        key, place, row = key[order], place[order], row[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(first, len(key)))
        known = np.maximum.reduceat(place, first) == _SHARED
        known |= np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
        good = np.repeat(known, count) & (place != _SHARED)
        row, place = row[good], place[good].astype("<u2")
        order = np.argsort(row, kind="stable")
        bounds = np.searchsorted(row[order], np.arange(len(parts) + 1))
        place = place[order]
        data = [place[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        used = [i for i, x in enumerate(data) if x]
        return pa.table(
            {
                "block": table["block"].combine_chunks().take(pa.array(used, pa.int64())),
                "data": pa.array([data[i] for i in used], pa.binary()),
                "kind": pa.array([0] * len(used), pa.int64()),
            }
        )

    return shared


def _settled(table: pa.Table) -> pa.Table:
    """Shared n-grams of each set of a block, summed over the ranges."""
    rows, own = [], None
    for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
        if kind == 1:
            count = int(np.frombuffer(data, "<u4", 1)[0])
            own = np.frombuffer(data, "<u4", count, 4).astype(np.int64)
            lengths = np.frombuffer(data, "<u4", count, 4 + 4 * count)
            at = 4 + 8 * count
            for length in lengths.tolist():
                rows.append(data[at : at + length])
                at += length
    for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
        if kind == 0:
            own = own + np.bincount(np.frombuffer(data, "<u2"), minlength=len(own))
    return pa.table({"row": pa.array(rows, pa.binary()), "shared": pa.array(own, pa.int64())})


def shared_counts(dealt: DataFrame, bits: int) -> DataFrame:
    """Rows of blocks with the number of their n-grams that also occur elsewhere.

    n-grams are told apart by their leading bits only, enough for one false match in some
    ten; a count may thus be too large, never too small.
    """
    places = dealt.groupBy("range").applyInArrow(_sharer(bits), "block long, data binary, kind long")
    return places.groupBy("block").applyInArrow(_settled, "row binary, shared long")


def _range_bits(size: int) -> int:
    return max(0, math.ceil(math.log2(max(size, 1) / RANGE_BYTES)))


def _text_dealer(bits: int):
    @releasing
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = _Block(bits), TaskContext.get().partitionId() << 24
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 2)]
            for doc, key, grams in zip(*columns, gram_sets(batch.column(1)), strict=True):
                row = np.array([doc is None, doc or 0, key, len(grams)], "<i8").tobytes()
                block.add(grams, len(block.sets), row + xxhash.xxh3_128_digest(grams.tobytes()))
                if block.full():
                    yield block.dealt(at)
                    block, at = _Block(bits), at + 1
        if block.sets:
            yield block.dealt(at)

    return deal



def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0).to_pylist()
        values = np.frombuffer(b"".join(x[:32] for x in rows), "<i8").reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(values[:, 1], mask=values[:, 0] != 0),
                pa.array(values[:, 2]),
                pa.array(values[:, 3]),
                pa.array([x[32:] for x in rows], pa.binary()),
                batch.column(1),
            ],
            ["doc_id", "text_key", "n", "class", "shared"],
        )


def set_sizes(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n (n-grams), class (digest of the set) and shared (n-grams found elsewhere)."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _range_bits(size)
    texts = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("key"))
    counted = shared_counts(texts.mapInArrow(_text_dealer(bits), _DEALT), bits)
    return counted.mapInArrow(
        _unrolled, "doc_id long, text_key long, n long, class binary, shared long"
    )


# -- Classes and their fragments ----------------------------------------------------------

_SEGMENTS = "cid long, class binary, n long, fragment long, grams array<long>, keys array<long>, parity array<long>"


def _parity(grams: np.ndarray) -> np.ndarray:
    """For each of some groups of n-grams, by hash, whether the set holds an odd number."""
    group = (grams & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64)
    return np.packbits(np.bincount(group, minlength=64 * PARITY_WORDS) & 1).view(np.int64)


@releasing
def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets cut at fixed places of the global order."""
    at = TaskContext.get().partitionId() << 33
    cuts = np.array([(k << 64) // FRAGMENTS for k in range(1, FRAGMENTS)], np.uint64)
    for batch in batches:
        for first in range(0, batch.num_rows, 50):
            part = batch.slice(first, 50)
            cid, classes, sizes, fragments, grams, keys, parity = [], [], [], [], [], [], []
            for wanted, own in zip(part.column(0).to_pylist(), gram_sets(part.column(1)), strict=True):
                if xxhash.xxh3_128_digest(own.tobytes()) != wanted:
                    continue  # another text under the same id
                bounds = [0, *np.searchsorted(own, cuts).tolist(), len(own)]
                for k in range(FRAGMENTS):
                    cid.append(at)
                    classes.append(wanted)
                    sizes.append(len(own))
                    fragments.append(k)
                    grams.append(own[bounds[k] : bounds[k + 1]].view(np.int64))
                    least = [int(mix(own ^ s).min()) >> 1 for s in _SEEDS] if k == 0 else []
                    keys.append(np.array(least, np.int64))
                    parity.append(_parity(own) if k == 0 else keys[-1])
                at += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cid, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(fragments, pa.int64()),
                    *[
                        pa.ListArray.from_arrays(
                            pa.array(np.cumsum([0, *map(len, x)]), pa.int32()),
                            pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()),
                        )
                        for x in (grams, keys, parity)
                    ],
                ],
                ["cid", "class", "n", "fragment", "grams", "keys", "parity"],
            )


def segments(documents: DataFrame, sizes: DataFrame) -> DataFrame:
    """Fragments of the classes that may link, as a written table; cid numbers the classes."""
    hopeful = sizes.filter("n > 0 and 4 * shared >= 3 * n")
    chosen = hopeful.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("of")).select(
        F.col("class"), F.col("of.doc_id").alias("_doc"), F.col("of.text_key").alias("_key")
    )
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    same = texts.doc_id.eqNullSafe(chosen._doc) & (F.xxhash64("text") == chosen._key)
    cut = staged(
        texts.join(chosen, same).select("class", "text").mapInArrow(_cutter, _SEGMENTS), "segments"
    )
    once = cut.filter("fragment = 0").groupBy("class").agg(
        F.min("cid").alias("cid"), F.count("*").alias("times")
    )
    if once.filter("times > 1").isEmpty():
        return cut
    return staged(cut.join(once.select("cid"), "cid", "left_semi"), "segments")


@releasing
def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap in one fragment, unless its differences exceed what a similar pair may have."""
    for batch in batches:
        left, right = batch.column(4), batch.column(5)
        offsets = [np.asarray(x.offsets) for x in (left, right)]
        values = [np.asarray(x.values).view(np.uint64) for x in (left, right)]
        sizes = np.asarray(batch.column(2)) + np.asarray(batch.column(3))
        allowed = sizes - 2 * -(-3 * sizes // 7)
        kept, found = [], []
        for row in range(batch.num_rows):
            a, b = (v[o[row] : o[row + 1]] for v, o in zip(values, offsets, strict=True))
            both = np.sort(np.concatenate((a, b)), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            if len(both) - 2 * common <= allowed[row]:
                kept.append(row)
                found.append(common)
        out = batch.select([0, 1, 2, 3]).take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(found, pa.int64())], ["a", "b", "n_a", "n_b", "common"]
        )


def verified(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that are similar: overlaps by fragment, summed per pair."""
    right = cut.select(
        F.col("cid").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("grams").alias("grams_b")
    )
    left = cut.select(
        F.col("cid").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("grams").alias("grams_a")
    )
    both = pairs.select("a", "b").join(right, "b").join(left, ["a", "fragment"])
    partial = both.select("a", "b", "n_a", "n_b", "grams_a", "grams_b").mapInArrow(
        _overlaps, "a long, b long, n_a long, n_b long, common long"
    )
    return (
        partial.groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("common").alias("common"), F.count("*").alias("fragments"))
        .filter((F.col("fragments") == FRAGMENTS) & similar(F.col("common"), F.col("n_a"), F.col("n_b")))
        .select("a", "b", "common", "n_a", "n_b")
    )


def _sizes_fit(left: Column, right: Column) -> Column:
    return 4 * F.least(left, right) >= 3 * F.greatest(left, right)


def stars(cut: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Each class with one that has the same least n-gram, for several hashes.

    Every hash, and every turn, picks its hubs by another order, so that one odd hub
    does not keep a group apart. ``labels`` (cid, component) names the classes that take
    part; pairs within a component are left out.
    """
    keyed = (
        cut.filter("fragment = 0")
        .join(labels.select("cid", "component"), "cid")
        .select("cid", "n", "component", F.posexplode("keys").alias("hash", "key"))
    )
    place = F.xxhash64("cid", "hash", F.lit(turn)).alias("place")
    hubs = keyed.groupBy("hash", "key").agg(
        F.min(F.struct(place, "cid", "n", "component")).alias("hub"), F.count("*").alias("members")
    )
    met = keyed.join(hubs.filter("members > 1"), ["hash", "key"])
    fit = (F.col("hub.component") != F.col("component")) & _sizes_fit(F.col("n"), F.col("hub.n"))
    pair = F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")
    return met.filter(fit).select(*pair).distinct()


def _class_dealer(bits: int):
    @releasing
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = _Block(bits), TaskContext.get().partitionId() << 24
        for batch in batches:
            offsets, values = np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).values)
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for i, (cid, component) in enumerate(rows):
                grams = values[offsets[i] : offsets[i + 1]].view(np.uint64)
                block.add(grams, component, np.array([cid], "<i8").tobytes())
                if block.full():
                    yield block.dealt(at)
                    block, at = _Block(bits), at + 1
        if block.sets:
            yield block.dealt(at)

    return deal


def _cids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cid = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(cid), batch.column(1)], ["cid", "shared"])


def outside(cut: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes with three quarters of their n-grams in other components: cid, n, component."""
    size = cut.agg(F.sum(F.size("grams"))).first()[0] or 0
    bits = _range_bits(6 * size)
    named = cut.join(labels, "cid").select("cid", "component", "grams")
    dealt = named.repartition("component").mapInArrow(_class_dealer(bits), _DEALT)
    counts = shared_counts(dealt, bits).mapInArrow(_cids, "cid long, shared long")
    sizes = cut.filter("fragment = 0").select("cid", "n")
    return (
        counts.groupBy("cid")
        .agg(F.sum("shared").alias("shared"))
        .join(sizes, "cid")
        .filter("4 * shared >= 3 * n")
        .join(labels, "cid")
        .select("cid", "n", "component")
    )


def across(cut: DataFrame, open_classes: DataFrame) -> DataFrame:
    """Candidate pairs of different components by prefix, rarest n-grams first.

    n-grams of one component come first in the order: they use up places of the prefix
    and meet nothing there.
    """
    grams = staged(
        cut.join(open_classes, ["cid", "n"]).select(
            "cid", "n", "component", F.explode("grams").alias("gram")
        ),
        "grams",
    )
    met = (
        grams.groupBy("gram")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("held"),
        )
        .filter("low != high")
        .select("gram", "held")
    )
    own = Window.partitionBy("cid").orderBy("held", "gram")
    ranked = (
        grams.join(met, "gram")
        .withColumn("rank", F.row_number().over(own))
        .withColumn("mixed", F.count("*").over(Window.partitionBy("cid")))
        .filter("rank <= (n DIV 4) + 1 - (n - mixed)")
    )
    parity = cut.filter("fragment = 0").select(
        "cid", *[F.col("parity")[k].alias(f"p{k}") for k in range(PARITY_WORDS)]
    )
    kept = ranked.filter("4 * mixed >= 3 * n").select("cid", "n", "component", "mixed", "gram")
    prefix = staged(kept.join(parity, "cid"), "prefixes")
    left, right = prefix.alias("x"), prefix.alias("y")
    both = F.col("x.n") + F.col("y.n")
    apart = sum(
        F.bit_count(F.col(f"x.p{k}").bitwiseXOR(F.col(f"y.p{k}"))) for k in range(PARITY_WORDS)
    )
    fit = (
        (F.col("x.component") < F.col("y.component"))
        & _sizes_fit(F.col("x.n"), F.col("y.n"))
        & (7 * F.least("x.mixed", "y.mixed") >= 3 * both)
        & (7 * apart <= both)
    )
    return (
        left.join(right, (F.col("x.gram") == F.col("y.gram")) & fit)
        .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        .distinct()
    )


def grouped(cut: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of some turns of stars, the components they make, and the classes still open."""
    labels = classes.select("cid", F.col("cid").alias("component"))
    part, links = labels, None
    for turn in range(TURNS):
        new = staged(verified(stars(cut, part, turn), cut).select("a", "b"), "links")
        links = new if links is None else links.unionAll(new)
        if turn == 0 or not new.isEmpty():
            labels = _labels(classes, components(links))
        part = staged(outside(cut, labels), "open")
        if part.isEmpty():
            break
    return links, labels, part


def linked(documents: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, class, component_id."""
    sizes = staged(set_sizes(documents), "sets")
    cut = segments(documents, sizes)
    classes = cut.filter("fragment = 0").select("cid", "class")
    links, ends, open_classes = grouped(cut, classes)
    more = staged(verified(staged(across(cut, open_classes), "pairs"), cut), "links")
    if not more.isEmpty():
        ends = _labels(classes, components(links.select("a", "b").unionAll(more.select("a", "b"))))
    smallest = sizes.groupBy("class").agg(F.min("doc_id").alias("doc"))
    named = classes.join(ends, "cid").join(smallest, "class")
    by_component = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    found = named.join(by_component, "component").select("class", "component_id", F.lit(True).alias("in"))
    return sizes.join(found, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "class",
        F.when(F.col("in") & (F.col("n") > 0), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def _labels(classes: DataFrame, found: DataFrame) -> DataFrame:
    """The component of every class; one without links is its own."""
    joined = classes.join(found, classes.cid == found.node, "left")
    return staged(joined.select("cid", F.coalesce("component", "cid").alias("component")), "labels")
