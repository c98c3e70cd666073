"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers encode a text; the running byte lengths of their tokens are two rising
lists of ends. Galloping intersection finds the ends they share: each end of the shorter
list is looked for in the longer one, from where the last one was found, by doubling
steps and then by halving them. Shared ends cut both token lists into groups, and the
ranks found give, as differences, the range of tokens that each token overlaps. The lists
of many documents are walked side by side, in lanes of LANE ends.

Links (pairs of overlapping tokens) are counted over the whole corpus. Documents go in
blocks of about BLOCK_LINKS links; a block has a list of its distinct id pairs, and its
documents name links by place in that list. Only these lists are shuffled by pair, to be
summed over all blocks; the sums come back to the block, where each document looks its
own up. No step holds more than a block, and no table of all pairs is held anywhere.

Words between single spaces are encoded once and remembered, as neither tokenizer joins
what a space divides; texts with other white space next to a space, and those with a word
that does not come back byte for byte, are encoded whole.

Null and empty texts, and texts whose joined token bytes differ from space + text under
either tokenizer, have no tokens: zeros, no links. Null ids stay, repeated rows each give
a row and count each, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.words import row_chunks
from wakeline.sources.staging import staged

LANE = 64
BLOCK_LINKS = 1 << 21
CACHED = 400_000
# A space is a sure cut only between two characters that are no white space.
_UNSURE = re.compile(r"^ | $| [\s\u180e\u200b]|[\s\u180e\u200b] ")
# Fixed: byte-level vocabularies write a printable Latin-1 byte as itself, the others
# in order as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTED} | {
    chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))
}
_open: dict[tuple[str, str, int], Pair] = {}


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] - 1 of all i, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


class _Store:
    """Token ids of remembered pieces in one growing array."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.starts, self.count = np.zeros(1 << 12, np.int64), 0

    def add(self, pieces: list) -> None:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter((i for ids in pieces for i in ids), np.int32, int(sizes.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while self.count + len(sizes) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.empty_like(self.starts)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[self.count + 1 : self.count + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(flat)
        self.count += len(sizes)

    def cut(self, count: int) -> None:
        self.count, self.used = count, int(self.starts[count])

    def take(self, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in the order named, and the bounds of rows of pieces in them."""
        sizes = self.starts[places + 1] - self.starts[places]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return self.ids[ragged(self.starts[places], sizes)], ends[bounds]


@dataclass
class Tokens:
    """Ids of consecutive documents; document i owns bounds[i]:bounds[i+1]."""

    ids: np.ndarray
    bounds: np.ndarray

    def rows(self, chosen: np.ndarray) -> Tokens:
        sizes = np.diff(self.bounds)[chosen]
        return Tokens(
            self.ids[ragged(self.bounds[:-1][chosen], sizes)], np.concatenate(([0], np.cumsum(sizes)))
        )


class Pair:
    """Two tokenizers with the bytes of their tokens: a byte-level one, and one of pieces."""

    def __init__(self, path_a: str, path_b: str, cached: int = CACHED):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.cached = cached
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(_BYTE_OF[c] for c in token)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        inner = [x for x in self.bytes_b if b" " in x.lstrip(b" ")]
        if inner or self.a.normalizer is not None:
            raise ValueError("a space must divide what both tokenizers encode")
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.known_a, self.known_b = _Store(), _Store()
        self.exact = np.zeros(0, bool)

    def _encode(self, pieces: list[str]) -> tuple[list, list, list[bool]]:
        own = [f" {piece}" for piece in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(own, add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        exact = []
        for ids_a, ids_b, text in zip(a, b, own, strict=True):
            data = text.encode()
            exact.append(
                b"".join(map(self.bytes_a.__getitem__, ids_a)) == data
                and b"".join(map(self.bytes_b.__getitem__, ids_b)) == data
            )
        return a, b, exact

    def _remember(self, pieces: list[str]) -> None:
        a, b, exact = self._encode(pieces)
        self.known_a.add(a)
        self.known_b.add(b)
        self.exact = np.append(self.exact, exact)

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Token ids of whole texts; none where the bytes do not come back."""
        if len(self.place) > self.cached:
            self.forget()
        sure = [bool(text) and not _UNSURE.search(text) for text in texts]
        words = [text.split(" ") if good else [] for text, good in zip(texts, sure, strict=True)]
        flat = [word for row in words for word in row]
        fresh = sorted(set(flat) - self.place.keys())
        if fresh:
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self._remember(fresh)
        kept = self.known_a.count
        places = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        wrong = np.concatenate(([0], np.cumsum(~self.exact[places])))
        whole = [
            i for i, text in enumerate(texts) if text and (not sure[i] or wrong[bounds[i + 1]] > wrong[bounds[i]])
        ]
        if whole:
            self._remember([texts[i] for i in whole])
            rows = [places[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
            for k, i in enumerate(whole):
                rows[i] = np.array([kept + k] if self.exact[kept + k] else [], np.int64)
            places = np.concatenate(rows)
            bounds = np.concatenate(([0], np.cumsum([len(row) for row in rows])))
        found = tuple(Tokens(*store.take(places, bounds)) for store in (self.known_a, self.known_b))
        for store in (self.known_a, self.known_b):
            store.cut(kept)
        self.exact = self.exact[:kept]
        return found


def pair(*named) -> Pair:
    """One pair of tokenizers and its remembered words, kept while the worker lives."""
    if named not in _open:
        _open[named] = Pair(*named)
    return _open[named]


def gallop(short: np.ndarray, long: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each end in ``short`` the place of the first end in ``long`` that reaches it.

    Lane k walks short[first[k]:last[k]] and starts in ``long`` at at[k]; every end must
    be reached somewhere in ``long`` at or after that place.
    """
    ranks = np.empty(len(short), np.int64)
    first, at = first.copy(), at.copy()
    open_ = np.flatnonzero(first < last)
    top = len(long) - 1
    while len(open_):
        here = first[open_]
        value = short[here]
        low = at[open_]
        high = low.copy()
        step = 1
        far = np.flatnonzero(long[high] < value)
        while len(far):
            low[far] = high[far] + 1
            high[far] = np.minimum(high[far] + step, top)
            step *= 2
            far = far[long[high[far]] < value[far]]
        apart = np.flatnonzero(low < high)
        while len(apart):
            middle = (low[apart] + high[apart]) >> 1
            below = long[middle] < value[apart]
            low[apart] = np.where(below, middle + 1, low[apart])
            high[apart] = np.where(below, high[apart], middle)
            apart = apart[low[apart] < high[apart]]
        ranks[here] = low
        at[open_] = low
        first[open_] += 1
        open_ = open_[first[open_] < last[open_]]
    return ranks


@dataclass
class Aligned:
    """Documents aligned: common ends as places in either list, and links as places."""

    common_short: np.ndarray
    common_long: np.ndarray
    link_short: np.ndarray
    link_long: np.ndarray
    groups: np.ndarray
    links: np.ndarray


def align_ends(short: np.ndarray, short_at: np.ndarray, long: np.ndarray, long_at: np.ndarray) -> Aligned:
    """Align lists of ends that run on over all documents, the driving list first.

    ``short_at`` and ``long_at`` bound the documents, each of which ends at the same byte
    in both lists.
    """
    sizes = np.diff(short_at)
    lanes = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(sizes)), lanes)
    first = ragged(np.zeros(len(sizes), np.int64), lanes) * LANE + short_at[:-1][owner]
    last = np.minimum(first + LANE, short_at[1:][owner])
    ranks = gallop(short, long, first, last, long_at[:-1][owner])
    shared = long[ranks] == short if len(short) else np.zeros(0, bool)
    # A token's range begins after the last one's end, and ends with the token that reaches its own.
    begins = np.concatenate(([0], (ranks + shared)[:-1])) if len(short) else ranks
    counts = ranks - begins + 1
    total = np.concatenate(([0], np.cumsum(counts)))
    groups = np.concatenate(([0], np.cumsum(shared)))
    return Aligned(
        np.flatnonzero(shared),
        ranks[shared],
        np.repeat(np.arange(len(short)), counts),
        ragged(begins, counts),
        np.diff(groups[short_at]),
        np.diff(total[short_at]),
    )


def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 .. size-1 from the left, and how many each has."""
    width = len(str(max(size - 1, 1)))
    number = np.arange(size)
    many = np.ones(size, np.int64)
    for power in range(1, width):
        many += number >= 10**power
    digits = np.zeros((size, width), np.uint8)
    for place in range(width):
        shift = many - 1 - place
        digits[:, place] = np.where(shift >= 0, number // 10 ** np.maximum(shift, 0) % 10 + 48, 0)
    return digits, many


def group_texts(
    a: Tokens, b: Tokens, cuts_a: np.ndarray, cuts_b: np.ndarray, groups: np.ndarray, decimals
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3`` of all documents, and their bounds.

    ``cuts_a`` and ``cuts_b`` are the last tokens of the groups, ``groups`` counts them by
    document. Every group ends with a semicolon here, the last one's included.
    """
    digits, many = decimals
    size_a, size_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    of_a, of_b = np.repeat(np.arange(len(size_a)), size_a), np.repeat(np.arange(len(size_b)), size_b)
    to_a = np.arange(len(a.ids)) + (cuts_b - size_b + 1)[of_a]
    to_b = np.arange(len(b.ids)) + (cuts_a + 1)[of_b]
    ids = np.empty(len(a.ids) + len(b.ids), np.int64)
    marks = np.full(len(ids), ord(","), np.uint8)
    ids[to_a], ids[to_b] = a.ids, b.ids
    marks[to_a[cuts_a]], marks[to_b[cuts_b]] = ord("|"), ord(";")
    widths = many[ids]
    ends = np.cumsum(widths + 1)
    starts = ends - widths - 1
    text = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for place in range(digits.shape[1]):
        has = np.flatnonzero(widths > place)
        text[starts[has] + place] = digits[ids[has], place]
    text[ends - 1] = marks
    last = np.concatenate(([0], ends))
    return text, last[a.bounds + b.bounds]


_COLUMNS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, groups string, links binary, pairs binary, counts binary"
)


def _aligner(path_a: str, path_b: str, texts_too: bool, block_links: int, cached: int):
    schema = pa.schema(
        [
            (name, {"long": pa.int64(), "string": pa.large_string(), "binary": pa.large_binary()}[kind])
            for name, kind in (part.split() for part in _COLUMNS.split(", "))
        ]
    )

    def aligned_rows(tools: Pair, decimals, ids: list, texts: list[str]) -> tuple[list[tuple], list[np.ndarray]]:
        """One row for each document, and its links as pair numbers."""
        both = tools.encode(texts)
        sizes = [np.diff(t.bounds) for t in both]
        rows: list[tuple] = [()] * len(ids)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        some = sizes[0] > 0
        for chosen, a_drives in ((some & (sizes[0] <= sizes[1]), True), (some & (sizes[0] > sizes[1]), False)):
            which = np.flatnonzero(chosen)
            a, b = (t.rows(which) for t in both)
            ends_a, ends_b = np.cumsum(tools.sizes_a[a.ids]), np.cumsum(tools.sizes_b[b.ids])
            if a_drives:
                got = align_ends(ends_a, a.bounds, ends_b, b.bounds)
                cuts_a, cuts_b, link_a, link_b = got.common_short, got.common_long, got.link_short, got.link_long
            else:
                got = align_ends(ends_b, b.bounds, ends_a, a.bounds)
                cuts_b, cuts_a, link_b, link_a = got.common_short, got.common_long, got.link_short, got.link_long
            pairs = b.ids[link_b].astype(np.int64) * len(tools.bytes_a) + a.ids[link_a]
            text, at = group_texts(a, b, cuts_a, cuts_b, got.groups, decimals)
            data = memoryview(text)
            upto = np.concatenate(([0], np.cumsum(got.links)))
            for k, i in enumerate(which.tolist()):
                own = data[at[k] : at[k + 1] - 1]
                rows[i] = (
                    int(sizes[0][i]),
                    int(sizes[1][i]),
                    int(got.groups[k]),
                    int(got.links[k]),
                    hashlib.sha256(own).hexdigest(),
                    str(own, "ascii") if texts_too else None,
                )
                found[i] = pairs[upto[k] : upto[k + 1]]
        return [row or (0, 0, 0, 0, "", "" if texts_too else None) for row in rows], found

    def align_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = pair(path_a, path_b, cached)
        decimals = _decimals(max(len(tools.bytes_a), len(tools.bytes_b)))
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        links: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            pairs, inverse, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            inverse = inverse.astype("<u4")
            rows, at = [], 0
            for row, own in zip(held, links, strict=True):
                rows.append((block, *row, inverse[at : at + len(own)].tobytes(), None, None))
                at += len(own)
            if len(pairs):
                rows.append((block, *[None] * 8, pairs.astype("<i8").tobytes(), counts.astype("<i8").tobytes()))
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)],
                schema=schema,
            )

        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            ids = batch.column(0).to_pylist()
            for first, last in row_chunks(offsets):
                whole = [text or "" for text in texts[first:last].to_pylist()]
                for doc_id, row, own in zip(
                    ids[first:last], *aligned_rows(tools, decimals, ids[first:last], whole), strict=True
                ):
                    held.append((doc_id, *row))
                    links.append(own)
                    size += len(own)
                if size >= block_links:
                    yield flush()
                    held, links, size, block = [], [], 0, block + 1
        if held:
            yield flush()

    return align_texts


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pair of a block, with its place in the block's list."""
    for batch in batches:
        for block, pairs, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            known = np.frombuffer(pairs, "<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(known), block)),
                    pa.array(np.arange(len(known), dtype=np.int32)),
                    pa.array(known),
                    pa.array(np.frombuffer(counts, "<i8")),
                ],
                ["block", "place", "pair", "own"],
            )


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "n_best long, count_sum long, groups_sha256 string, groups string"
)


def _look_up(documents: pa.Table, sums: pa.Table) -> pa.Table:
    """Sums over the links of the documents of one block."""
    places = np.array(sums["place"])
    count, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    count[places], best[places] = np.array(sums["n"]), np.array(sums["best"])
    links = documents["links"].to_pylist()
    at = np.frombuffer(b"".join(links), "<u4")
    bounds = np.concatenate(([0], np.cumsum([len(own) // 4 for own in links], dtype=np.int64)))
    out = {name: documents[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name, values in (("n_best", best), ("count_sum", count)):
        total = np.concatenate(([0], np.cumsum(values[at], dtype=np.int64)))
        out[name] = pa.array(np.diff(total[bounds]))
    return pa.table(out | {name: documents[name] for name in ("groups_sha256", "groups")})


def align(
    documents: DataFrame,
    path_a: str,
    path_b: str,
    texts: bool = False,
    block_links: int = BLOCK_LINKS,
    cached: int = CACHED,
) -> DataFrame:
    """Align the tokens of each document: counts, the digest of its groups, sums over links.

    ``documents`` needs doc_id and text. ``path_a`` names a byte-level tokenizer, which
    gets space + text, ``path_b`` a model of pieces, which adds the space. With ``texts``
    the column ``groups`` holds the groups as ``a1,a2|b1;a3|b2,b3``.
    """
    size_a = len(pair(path_a, path_b, cached).bytes_a)
    rows = staged(
        documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            _aligner(path_a, path_b, texts, block_links, cached), _COLUMNS
        ),
        "aligned",
    )
    pairs = (
        rows.filter("pairs is not null")
        .select("block", "pairs", "counts")
        .mapInArrow(_unpack, "block long, place int, pair long, own long")
    )
    sums = pairs.groupBy("pair").agg(F.sum("own").alias("n"))
    sums = staged(sums.withColumn("b", F.expr(f"pair div {size_a}")), "links")
    # One row for each id of the second tokenizer at most: bounded by its vocabulary.
    highest = sums.groupBy("b").agg(F.max("n").alias("most"))
    known = sums.join(F.broadcast(highest), "b").select(
        "pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")
    )
    back = pairs.select("block", "place", "pair").join(known, "pair").select("block", "place", "n", "best")
    texts_of = rows.filter("pairs is null").drop("pairs", "counts")
    return texts_of.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_look_up, _RESULT)


def counted(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The digest alone, without the texts of the groups."""
    return align(documents, path_a, path_b).drop("groups")
