"""Token ids in Huffman-coded blocks.

Each text is encoded by a tokenizer, an end id follows, and the ids are kept as 16- or
32-bit integers. Their counts over the whole corpus give one canonical Huffman code of
limited length. A file is a Parquet table of blocks in ascending order of documents. A
block holds whole documents, about BLOCK_IDS ids: their doc ids and lengths, the bits,
and the bit offset of every CHECKPOINT-th id. It is decoded alone, with the code lengths
as the only other input, and all stretches between checkpoints are decoded in step.

The tokenizer is asked for pieces between spaces, once for each piece that a worker
meets again and again. Spaces separate tokens in such tokenizers (checked when one is
opened), so the ids equal those of the whole text.

Null texts are empty and give the end id alone. Null ids come first; repeated rows are
kept, in order of id and content. An empty table gives no block.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.huffman import CHECKPOINT, Codes, code_lengths, decode, encode
from wakeline.sources.staging import staged

BLOCK_IDS = 1 << 16
CACHED = 700_000
_open: dict[tuple[str, int], _Pieces] = {}
# Punctuation that may close a word; an apostrophe may belong to what follows it.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
# Fixed: byte-level vocabularies write a printable Latin-1 byte as itself, the others
# in order as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class _Pieces(dict):
    """Ids of pieces as bytes, filled by the tokenizer; older pieces are dropped in bulk.

    Capitals and a closing run of punctuation are taken off plain Latin words first, and
    the word alone is looked up, or given to the tokenizer's model. That holds for
    tokenizers that fold case and split words from punctuation; others (``plain`` is
    False then) get every piece as it is.
    """

    def __init__(self, path: str, wide: bool, cached: int):
        from tokenizers import Tokenizer

        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind, self.code = ("<u4", "I") if wide else ("<u2", "H")
        self.stems: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        own = [self._ids(x) for x in ("a", "b", "a b", "a  b", "a\nb")]
        if any(own[0] + own[1] != x for x in own[2:]):
            raise ValueError(f"{path} does not drop white space between tokens")
        self.plain = all(
            self._word(x.lower()) + self._ids(end) == self._ids(x + end)
            for x in ("the", "Hello", "ANTIDISESTABLISHMENT", "École", "Straße")
            for end in (".", ",", "!!", ".!!", "?")
        )

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one lower-case word by the model, which knows bytes as characters."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_SPELLED)
        return array(self.code, [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        word = piece.rstrip(_MARKS)
        if self.plain and word.isalpha():
            low = word.lower()
            ids = self.stems.get(low)
            if ids is None:
                if not low.isascii() and (max(low) >= "\u0250" or len(low) != len(word)):
                    return self._ids(piece)
                ids = self.stems[low] = self._word(low)
            if len(word) != len(piece):
                mark = piece[len(word) :]
                if mark not in self.marks:
                    self.marks[mark] = self._ids(mark)
                ids += self.marks[mark]
        else:
            ids = self._ids(piece)
        self[piece] = ids
        return ids

    def trimmed(self) -> None:
        """Forget what exceeds the limit; asked for after every few texts."""
        for known in (self, self.stems, self.marks):
            if len(known) > self.cached:
                known.clear()


def _pieces(path: str, wide: bool, cached: int) -> _Pieces:
    """One cache for each tokenizer, kept while the worker lives."""
    if (path, cached) not in _open:
        _open[path, cached] = _Pieces(path, wide, cached)
    return _open[path, cached]


def _encoder(path: str, wide: bool, end_id: int, cached: int):
    def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path, wide, cached)
        end = np.array([end_id], pieces.kind).tobytes()
        width = len(end)
        get = pieces.__getitem__
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                pieces.trimmed()
                ids = [
                    b"".join(map(get, text.replace("\n", " ").split(" "))) + end if text else end
                    for text in part.column(1).to_pylist()
                ]
                counts = pa.array([len(x) // width for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), counts, pa.array(ids, pa.binary())], ["doc_id", "n", "ids"]
                )

    return encode_texts


@dataclass
class Ids:
    """Encoded documents: doc_id, n, ids (bytes of ``kind``)."""

    rows: DataFrame
    kind: str


def tokenize(documents: DataFrame, path: str, end_id: int, cached: int = CACHED) -> Ids:
    """Encode every whole text; written once, as counting and coding both read the ids."""
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) > 1 << 16
    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encoder(path, wide, end_id, cached), "doc_id long, n long, ids binary"
    )
    return Ids(staged(rows, "ids"), "<u4" if wide else "<u2")


def count_ids(ids: Ids) -> Codes:
    """One code for the whole corpus. A count for each id used reaches the driver."""
    kind = ids.kind

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = np.bincount(np.frombuffer(value.as_buffer(), kind))
                if len(own) > len(total):
                    total = np.pad(total, (0, len(own) - len(total)))
                total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = (
        ids.rows.select("ids")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .toPandas()
        .sort_values("id")
    )
    used = counts["id"].to_numpy(np.int64)
    return Codes(used, code_lengths(counts["n"].to_numpy(np.int64)))


_BLOCK = (
    "part long, start long, n_ids long, docs binary, nulls binary, counts binary, "
    "bits binary, checkpoints binary"
)


def _writer(codes: Codes, kind: str):
    ids_used, lengths_used = codes.ids, codes.lengths

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, length = Codes(ids_used, lengths_used).encoder()
        part, start = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal start
            ids = np.concatenate(held)
            bits, offsets = encode(ids, code, length)
            row = [
                part,
                start,
                len(ids),
                np.array([d or 0 for d in docs], "<i8").tobytes(),
                np.packbits([d is None for d in docs]).tobytes(),
                np.array([len(x) for x in held], "<u4").tobytes(),
                bits,
                offsets.astype("<u8").tobytes(),
            ]
            start += len(ids)
            docs.clear()
            held.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] * 5
            names = [x.split()[0] for x in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names
            )

        size = 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(doc)
                held.append(np.frombuffer(value.as_buffer(), kind))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    size = 0
        if docs:
            yield block()

    return write


def write_blocks(ids: Ids, codes: Codes, path: str) -> None:
    """Write the blocks in ascending order of documents, and the code lengths beside them.

    Documents are dealt by ranges of (doc_id, hash of ids), so equal ids may spread.
    """
    order = F.xxhash64("ids")
    ordered = (
        ids.rows.select("doc_id", "ids")
        .withColumn("_order", order)
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_order"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_order")
        .select("doc_id", "ids")
    )
    ordered.mapInArrow(_writer(codes, ids.kind), _BLOCK).write.option(
        "compression", "none"
    ).parquet(f"{path}/blocks")
    spark = ids.rows.sparkSession
    table = pa.table({"id": codes.ids, "bits": codes.lengths})
    spark.createDataFrame(table.to_pandas(), "id long, bits long").coalesce(1).write.parquet(
        f"{path}/codes"
    )


def _reader(codes: Codes):
    ids_used, lengths_used = codes.ids, codes.lengths

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths = Codes(ids_used, lengths_used).decoder()
        for batch in batches:
            for row in range(batch.num_rows):
                start, docs, nulls, counts, bits, checkpoints = (
                    column[row].as_py() for column in batch.columns
                )
                sizes = np.frombuffer(counts, "<u4").astype(np.int64)
                total = int(sizes.sum())
                offsets = np.frombuffer(checkpoints, "<u8")
                stretch = np.full(len(offsets), CHECKPOINT)
                stretch[-1] = total - CHECKPOINT * (len(offsets) - 1)
                data = np.frombuffer(bits + bytes(8), np.uint8)
                found = decode(data, offsets, stretch, ids, lengths).astype("<u4")
                ends = np.cumsum(sizes)
                whole = memoryview(found).cast("B")
                own = [whole[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                missing = np.unpackbits(np.frombuffer(nulls, np.uint8))[: len(sizes)].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(docs, "<i8"), pa.int64(), mask=missing),
                        pa.array(start + ends - sizes),
                        pa.array(sizes),
                        pa.array([zlib.crc32(x) for x in own], pa.int64()),
                        pa.array([x.tobytes() for x in own], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return read


def read_blocks(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode a file: doc_id, start, n_tokens, ids_crc32, and the ids (bytes) if asked for.

    Where a part starts follows from the earlier parts' sizes, one row a part.
    """
    table = spark.read.parquet(f"{path}/codes").toPandas()
    codes = Codes(table["id"].to_numpy(np.int64), table["bits"].to_numpy(np.int64))
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = dict(blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    parts = sorted(sizes)
    starts = np.cumsum([0, *(sizes[p] for p in parts)])[:-1].tolist()
    begins = spark.createDataFrame(
        list(zip(parts, starts, strict=True)), "part long, before long"
    )
    placed = blocks.join(F.broadcast(begins), "part").select(
        (F.col("before") + F.col("start")).alias("start"),
        "docs",
        "nulls",
        "counts",
        "bits",
        "checkpoints",
    )
    read = placed.mapInArrow(
        _reader(codes), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
    return read if with_ids else read.drop("ids")


def encode_documents(
    documents: DataFrame, tokenizer: str, end_id: int, path: str, cached: int = CACHED
) -> DataFrame:
    """Encode, write to ``path``, and read back; workers remember about ``cached`` pieces."""
    ids = tokenize(documents, tokenizer, end_id, cached)
    write_blocks(ids, count_ids(ids), path)
    return read_blocks(documents.sparkSession, path)
