"""Words of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is a run of bytes outside space and TAB to CR, with A-Z in lower case. All
texts of an Arrow batch are hashed together: a polynomial over the bytes, taken as
a difference of running sums, so no text is ever split into Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# A fixed random value for each byte, and an odd base with its inverse mod 2^64.
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """``base`` to the powers 0 to at least ``size``, mod 2^64."""
    known = _powers.get(base)
    if known is None or len(known) <= size:
        steps = np.full(max(size, CHUNK_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        _powers[base] = known = np.multiply.accumulate(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Hashes of the words of some consecutive rows; row i owns bounds[i]:bounds[i+1]."""

    first_row: int
    hashes: np.ndarray
    bounds: np.ndarray


def row_chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def words(texts: pa.Array) -> Iterator[Words]:
    """Hash the words of a string array; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for first, last in row_chunks(offsets):
        base, size = offsets[first], int(offsets[last] - offsets[first])
        text = data[base : base + size]
        edges = offsets[first : last + 1] - base
        gap = np.empty(size + 1, bool)
        gap[:size] = _SEPARATORS[text]
        gap[size] = True
        inside = ~gap[:size]
        opens = np.zeros(size + 1, bool)
        opens[edges] = True
        before = np.concatenate(([True], gap[: size - 1])) if size else gap[:0]
        starts = np.flatnonzero(inside & (before | opens[:size]))
        ends = np.flatnonzero(inside & (gap[1:] | opens[1:])) + 1
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUES[text] * _power(_BASE, size)[:size], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * _power(_INVERSE, size)[starts])
        yield Words(first, hashes, np.searchsorted(starts, edges))


_PLACES = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams of every row, with repeats, and their bounds.

    A row with fewer words has one n-gram, the whole sequence; one without words
    has none.
    """
    counts = np.diff(found.bounds)
    sizes = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    rows = np.repeat(np.arange(len(counts)), sizes)
    at = found.bounds[rows] + np.arange(bounds[-1]) - bounds[rows]
    end = found.bounds[rows + 1]
    total = np.minimum(counts[rows], width).astype(np.uint64)
    padded = np.concatenate((found.hashes, np.zeros(width, np.uint64)))
    for k in range(width):
        total += np.where(at + k < end, padded[at + k], np.uint64(0)) * _PLACES[k]
    return mix(total), bounds


def range_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges starts[i]:ends[i]; equal ranges have equal ones."""
    size = len(text)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUES[text] * _power(_BASE, size)[:size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, size)[starts])
