"""Elias-Fano sequences and an n-gram trie of them, read in place from one block of memory or a mapped file.

A rising sequence of n numbers below U is kept as its low bits, packed, and its
high bits in unary: about 2 + log2(U / n) bits a number. A trie has a level of
words and, for each further word of its n-grams, a level of pointers (where the
successors of each node above start) and a level of successors. Successors of a
node are numbers relative to their context: each range starts where the one
before ended, so a whole level rises and is one sequence. A look-up walks down
by a successor search inside the range of its context.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Numbers that are encoded or looked up at once, so that work space stays small beside a level.
BLOCK = 1 << 16


def blocks(n: int) -> Iterator[slice]:
    return (slice(i, min(n, i + BLOCK)) for i in range(0, n, BLOCK))


def _or_into(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """words[at] |= bits for rising ``at``."""
    if len(at):
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        words[at[starts]] |= np.bitwise_or.reduceat(bits, starts)


def _select(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``r`` of each word."""
    place, r = np.zeros(len(word), np.int64), r.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        n = np.bitwise_count(word & U64((1 << width) - 1)).astype(np.int64)
        up = r >= n
        r -= np.where(up, n, 0)
        word = np.where(up, word >> U64(width), word)
        place += up * width
    return place


class Sequence:
    """A rising sequence of unsigned 64-bit numbers over a buffer (see ``encode``)."""

    def __init__(self, buffer, at: int = 0):
        self.n, self.low_bits, lows, highs = (int(v) for v in np.frombuffer(buffer, np.int64, 4, at))
        at += 32
        self.low = np.frombuffer(buffer, U64, lows, at)
        self.high = np.frombuffer(buffer, U64, highs, at + 8 * lows)
        self.ones = np.frombuffer(buffer, np.int64, highs + 1, at + 8 * (lows + highs))   # set bits before each word
        self.zeros = np.arange(highs + 1, dtype=np.int64) * 64 - self.ones
        self.end = at + 8 * (lows + 2 * highs + 1)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        """``values``: rising, unsigned 64-bit."""
        values = np.asarray(values, U64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, ((top + 1) // max(1, n)).bit_length() - 1)
        low, high = np.zeros((n * bits + 63) // 64 + 1, U64), np.zeros(((top >> bits) + n + 1 + 63) // 64, U64)
        for at in blocks(n):
            i, part = np.arange(at.start, at.stop), values[at] & U64((1 << bits) - 1)
            if bits:
                start = i * bits
                word, shift = start >> 6, (start & 63).astype(U64)
                _or_into(low, word, part << shift)
                over = (start & 63) + bits > 64
                _or_into(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
            place = (values[at] >> U64(bits)).astype(np.int64) + i if bits < 64 else i
            _or_into(high, place >> 6, U64(1) << (place & 63).astype(U64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        return np.array([n, bits, len(low), len(high)], np.int64).tobytes() + low.tobytes() + high.tobytes() + ones.tobytes()

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U64)
        start = i * self.low_bits
        word, shift = start >> 6, (start & 63).astype(U64)
        out = self.low[word] >> shift
        over = (start & 63) + self.low_bits > 64
        out[over] |= self.low[word[over] + 1] << (U64(64) - shift[over])
        return out & U64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Numbers at places ``i``."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _select(self.high[word], i - self.ones[word])
        return ((place - i).astype(U64) << U64(self.low_bits)) | self._lows(i)

    def _zero(self, h: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, h, "right") - 1
        return word * 64 + _select(~self.high[word], h - self.zeros[word])

    def successor(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place in [start, stop) whose number is at least ``x`` (``stop`` if there is none), and whether it equals ``x``."""
        x = np.asarray(x, U64)
        h = x >> U64(self.low_bits)
        inside = h < U64(self.zeros[-1])
        h = np.where(inside, h, U64(0)).astype(np.int64)
        after = np.minimum(self._zero(h) - h, self.n)
        before = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) + 1 - h, 0)
        lo, hi = np.clip(before, start, stop), np.clip(after, start, stop)
        end, want = hi.copy(), x & U64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):   # buckets hold two numbers on average
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._lows(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        lo = np.where(inside, lo, stop)
        hit = inside & (lo < end)
        found = np.zeros(len(x), bool)
        found[hit] = self._lows(lo[hit]) == want[hit]
        return lo, found


def mapped(raw: bytes) -> mmap.mmap:
    """``raw`` in a memory map of its own."""
    region = mmap.mmap(-1, max(1, len(raw)))
    region.write(raw)
    return region


class Trie:
    """n-grams of one order: words (64-bit numbers), successors by level, back-off codes of contexts, codes of n-grams."""

    def __init__(self, buffer):
        self.buffer = buffer
        self.order, self.nodes, self.leaves = (int(v) for v in np.frombuffer(buffer, np.int64, 3))
        self.words = Sequence(buffer, 24)
        at, self.pointers, self.successors = self.words.end, [], []
        for _ in range(self.order - 1):
            self.pointers.append(Sequence(buffer, at))
            self.successors.append(Sequence(buffer, self.pointers[-1].end))
            at = self.successors[-1].end
        self.back_off = np.frombuffer(buffer, np.uint16, self.nodes, at)
        self.codes = np.frombuffer(buffer, np.uint16, self.leaves, at + 2 * self.nodes)

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie in a file, mapped: look-ups read the pages they touch."""
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @staticmethod
    def encode(words: np.ndarray, levels: list[np.ndarray], back_off: np.ndarray, codes: np.ndarray) -> bytes:
        """``words``: rising numbers. ``levels``: for each further word the rising numbers parent * len(words) + word.

        ``back_off`` has a code for each node of the last level but one (of the words if there is one level).
        """
        out = [np.array([len(levels) + 1, len(back_off), len(codes)], np.int64).tobytes(), Sequence.encode(words)]
        above, v = len(words), max(1, len(words))
        for key in levels:
            starts = np.searchsorted(key, np.arange(above + 1) * v)
            span = np.zeros(above, np.int64)
            full = np.flatnonzero(starts[1:] > starts[:-1])
            span[full] = key[starts[full + 1] - 1] % v + 1
            base = np.cumsum(span) - span
            ids = np.empty(len(key), np.int64)
            for at in blocks(len(key)):
                parent, word = np.divmod(key[at], v)
                ids[at] = base[parent] + word
            out += [Sequence.encode(starts), Sequence.encode(ids)]
            above = len(key)
        return b"".join([*out, back_off.astype("<u2").tobytes(), codes.astype("<u2").tobytes()])

    def word(self, numbers: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if it is not in the trie."""
        out = np.full(len(numbers), -1, np.int64)
        for at in blocks(len(numbers)):
            n = at.stop - at.start
            place, found = self.words.successor(numbers[at], np.zeros(n, np.int64), np.full(n, self.words.n, np.int64))
            out[at] = np.where(found, place, -1)
        return out

    def child(self, level: int, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Node below ``node`` for ``word`` (both from 0), -1 if there is none; ``level`` 0 lies under the words."""
        out = np.full(len(node), -1, np.int64)
        if self.successors[level].n:
            for at in blocks(len(node)):
                out[at] = self._child(self.pointers[level], self.successors[level], node[at], word[at])
        return out

    @staticmethod
    def _child(pointers: Sequence, ids: Sequence, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(node), -1, np.int64)
        ask = np.flatnonzero((node >= 0) & (word >= 0))
        start, stop = pointers.get(node[ask]).astype(np.int64), pointers.get(node[ask] + 1).astype(np.int64)
        base = np.zeros(len(ask), U64)
        later = np.flatnonzero(start > 0)
        base[later] = ids.get(start[later] - 1) + U64(1)
        place, found = ids.successor(base + word[ask].astype(U64), start, stop)
        out[ask[found]] = place[found]
        return out
