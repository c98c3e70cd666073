"""Chat formatting: conversations as marked-up text with a loss mask.

A turn becomes ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``. Inside roles and texts
every ``<``, any number of backslashes, ``|`` gets one more backslash, so the marks never
occur there and the text can be restored exactly; in roles backslashes and line ends are
escaped too. The mask covers the (escaped) text of assistant turns.

Bytes are assembled by column: headers, texts and endings have lengths, their running
sums are the places in the output, and each kind is copied by one scatter into a buffer
allocated once, which becomes the Arrow column. A conversation is written in pieces,
ordered by number: rows are dealt by ranges of (conversation, turn, role), so that a very
long conversation spreads over tasks.

Rows go by turn, null turns first, equal turns by role and text. Null roles and texts are
empty, a null conversation id is one conversation. An empty table gives no piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed marks of the template.
OPEN, CLOSE = b"<|im_start|>", b"<|im_end|>\n"
LEARNED = "assistant"
PIECE_BYTES = 1 << 22
PIECES = "conv_id long, piece long, text string, loss_first array<int>, loss_end array<int>"
TURN = re.compile(rb"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def escape_roles(roles: pa.Array) -> pa.Array:
    plain = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    return escape(plain)


def unescape(text: bytes) -> bytes:
    return re.sub(rb"<\\(\\*)\|", rb"<\1|", text)


def unescape_role(role: bytes) -> bytes:
    plain = unescape(role)
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], plain, flags=re.S)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> None:
    """Copy data[first:first+size] to out[to:to+size] for all rows at once."""
    before = np.cumsum(sizes) - sizes
    steps = np.arange(int(sizes.sum()))
    out[steps + np.repeat(to - before, sizes)] = data[steps + np.repeat(first - before, sizes)]


def assemble(
    conversations: pa.Array, roles: pa.Array, texts: pa.Array, first_piece: int
) -> pa.RecordBatch:
    """Format consecutive turns; a piece is a run of turns of one conversation."""
    texts = escape(texts.fill_null(""))
    coded = roles.fill_null("").dictionary_encode()
    names = escape_roles(coded.dictionary)
    which = np.asarray(coded.indices)
    learned = np.array([x == LEARNED for x in coded.dictionary.to_pylist()], bool)[which]
    headers = pa.array([OPEN + x.encode() + b"\n" for x in names.to_pylist()], pa.large_binary())
    head_data = np.frombuffer(headers.buffers()[2] or b"", np.uint8)
    head_offsets = np.frombuffer(headers.buffers()[1], np.int64)
    text_data, text_offsets = _bytes(texts)
    rows = len(texts)
    head_sizes = np.diff(head_offsets)[which]
    text_sizes = np.diff(text_offsets)
    close = np.full(rows, len(CLOSE))
    ends = np.cumsum(head_sizes + text_sizes + close)
    starts = ends - head_sizes - text_sizes - close
    out = np.empty(int(ends[-1]), np.uint8)
    _scatter(out, starts, head_data, head_offsets[which], head_sizes)
    _scatter(out, starts + head_sizes, text_data, text_offsets[:-1], text_sizes)
    _scatter(out, ends - len(CLOSE), np.frombuffer(CLOSE, np.uint8), np.zeros(rows, np.int64), close)

    ids = conversations.fill_null(0).to_numpy(zero_copy_only=False)
    null = np.asarray(conversations.is_null())
    new = np.ones(rows, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    opens = np.flatnonzero(new)
    bounds = np.append(starts[opens], ends[-1]).astype(np.int32)
    text = pa.StringArray.from_buffers(len(opens), pa.py_buffer(bounds), pa.py_buffer(out))
    at = np.flatnonzero(learned)
    piece_of = np.cumsum(new) - 1
    mask = np.searchsorted(piece_of[at], np.arange(len(opens) + 1)).astype(np.int32)
    base = starts[opens][piece_of[at]]
    lists = [
        pa.ListArray.from_arrays(pa.array(mask), pa.array((place - base).astype(np.int32)))
        for place in (starts[at] + head_sizes[at], ends[at] - len(CLOSE))
    ]
    return pa.RecordBatch.from_arrays(
        [
            conversations.take(pa.array(opens)),
            pa.array(first_piece + np.arange(len(opens)), pa.int64()),
            text,
            *lists,
        ],
        ["conv_id", "piece", "text", "loss_first", "loss_end"],
    )


def _assembler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece = TaskContext.get().partitionId() << 33
    for batch in batches:
        sizes = pc.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if last > first:
                part = batch.slice(first, last - first)
                made = assemble(part.column(0), part.column(1), part.column(2), piece)
                piece += made.num_rows
                yield made


def format_chats(conversations: DataFrame) -> DataFrame:
    """Pieces of formatted text with the byte ranges of the loss mask in each."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first()]
    return (
        conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, F.col("text").asc_nulls_first())
        .select("conv_id", "role", "text")
        .mapInArrow(_assembler, PIECES)
    )


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of whole conversations from their pieces, one piece in hand at a time."""
    names = [x.split()[0] for x in _DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, done = None, []

    def close() -> None:
        if now:
            conv, turns, said, chars, loss, size = now
            done.append((conv, turns, said.hexdigest(), chars, loss.hexdigest(), size))

    def flush() -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        made = pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
        )
        done.clear()
        return made

    for batch in batches:
        for row in range(batch.num_rows):
            conv, text, firsts, ends = (column[row].as_py() for column in batch.columns)
            if now is None or now[0] != conv:
                close()
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            data = text.encode()
            now[5] += len(text)
            for turn in TURN.finditer(data):
                now[1] += 1
                now[2].update(unescape_role(turn[1]) + b"\n" + unescape(turn[2]) + b"\n")
            for first, end in zip(firsts, ends, strict=True):
                learned = unescape(data[first:end])
                now[3] += len(learned.decode())
                now[4].update(learned)
        if done:
            yield flush()
    close()
    if done:
        yield flush()


def digests(pieces: DataFrame) -> DataFrame:
    """Read formatted pieces back, one row a conversation.

    A digest runs over a conversation's turns in order, so each conversation is read by
    one task, piece by piece.
    """
    return (
        pieces.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece")
        .select("conv_id", "text", "loss_first", "loss_end")
        .mapInArrow(_digester, _DIGESTS)
    )
