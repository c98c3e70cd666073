"""Canonical length-limited Huffman codes in numpy: lengths, codes, bits, and decoding."""

from __future__ import annotations

import numpy as np

MOST_BITS = 18
CHECKPOINT = 256


def code_lengths(weights: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits for positive weights (package-merge)."""
    count = len(weights)
    if count < 2:
        return np.ones(count, np.int64)
    most = max(most, int(np.ceil(np.log2(count))))
    order = np.argsort(weights, kind="stable")
    leaves = weights[order].astype(np.int64)
    levels, merged = [], leaves
    leaf = np.ones(count, bool)
    for _ in range(most - 1):
        levels.append(leaf)
        even = len(merged) // 2 * 2
        packed = merged[0:even:2] + merged[1:even:2]
        both = np.concatenate((leaves, packed))
        place = np.argsort(both, kind="stable")
        merged, leaf = both[place], place < count
    levels.append(leaf)
    lengths = np.zeros(count, np.int64)
    take = 2 * count - 2
    for leaf in reversed(levels):
        singles = int(leaf[:take].sum())
        lengths[order[:singles]] += 1
        take = 2 * (take - singles)
    return lengths


class Codes:
    """Codes of ids in order of (length, id); known from the ids and their lengths alone."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        place = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[place].astype(np.int64), lengths[place].astype(np.int64)
        self.bits = int(self.lengths.max(initial=1))
        width = np.int64(1) << (self.bits - self.lengths)
        self.firsts = np.cumsum(width) - width
        self._widths = width

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id."""
        size = int(self.ids.max(initial=0)) + 1
        code, length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code[self.ids] = self.firsts >> (self.bits - self.lengths)
        length[self.ids] = self.lengths
        return code, length

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length by the next ``bits`` bits."""
        size = 1 << self.bits
        ids, lengths = np.zeros(size, np.uint32), np.ones(size, np.uint8)
        filled = int(self._widths.sum())
        ids[:filled] = np.repeat(self.ids, self._widths)
        lengths[:filled] = np.repeat(self.lengths, self._widths)
        return ids, lengths


def encode(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids``, most significant first, and the bit offset of every CHECKPOINT-th id."""
    if not len(ids):
        return b"", np.empty(0, np.uint64)
    sizes = length[ids]
    ends = np.cumsum(sizes)
    at = ends - sizes
    word = at >> 5
    value = code[ids] << (64 - sizes - (at & 31)).astype(np.uint64)
    # Codes are shorter than a word, so a code starts in every word up to the last start.
    firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out = np.zeros(len(firsts) + 1, np.uint64)
    out[:-1] = np.add.reduceat(value >> np.uint64(32), firsts)
    out[1:] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), firsts)
    packed = out.astype(">u4").tobytes()
    return packed[: (int(ends[-1]) + 7) // 8], at[::CHECKPOINT].astype(np.uint64)


def decode(
    bits: np.ndarray, offsets: np.ndarray, counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Decode stretches of at most CHECKPOINT ids, all in step.

    ``bits`` are bytes followed by at least 8 more, ``offsets`` the stretches' first
    bits and ``counts`` their ids.
    """
    width = int(len(ids)).bit_length() - 1
    b = bits.astype(np.uint32)
    ahead = b[:-3] << np.uint32(24) | b[1:-2] << np.uint32(16) | b[2:-1] << np.uint32(8) | b[3:]
    order = np.argsort(-counts, kind="stable")
    at, left = offsets[order].astype(np.int64), counts[order]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint32)
    place = starts[order]
    running = np.searchsorted(-left, -np.arange(1, CHECKPOINT + 1), "right")
    for step in range(int(left.max(initial=0))):
        live = running[step]
        now = at[:live]
        window = ahead[now >> 3] << (now & 7).astype(np.uint32)
        index = window >> np.uint32(32 - width)
        out[place[:live] + step] = ids[index]
        at[:live] = now + lengths[index]
    return out
