"""Whole columns of text as byte arrays: slicing, hashing, and remembered lookups.

Everything here works on one Arrow batch inside a task. Batches are cut into
blocks of a few megabytes, so memory does not follow the size of a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit of the input reaches every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def byte_table(seed: int) -> np.ndarray:
    """A random word for each byte value."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, 257, dtype=_U) + _U(256 * seed)) * _U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base modulo 2^64, and of its inverse; grows as needed."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.ones(1, _U)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, _U(base), _U)
        out[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(out)

    def up(self, n: int) -> np.ndarray:
        if len(self._up) < n:
            self._up = self._table(self.base, max(n, 1 << 12))
        return self._up

    def down(self, n: int) -> np.ndarray:
        if len(self._down) < n:
            self._down = self._table(self.inverse, max(n, 1 << 12))
        return self._down


TABLES = (byte_table(1), byte_table(2))
POWERS = (Powers(0xD1342543DE82EF95), Powers(0xF1357AEA2E62A9C5))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the rows' offsets; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Packed:
    """Slices of a byte array as 64-bit words, each slice from its own first byte, the last word filled with zeros.

    Two slices are equal exactly if their lengths and their words are.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.lengths = ends - starts
        self.counts = (self.lengths + 7) >> 3
        self.first = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(len(starts)), self.counts)
        self.nth = np.arange(len(self.owner)) - self.first[self.owner]
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        at = starts[self.owner] + 8 * self.nth
        words = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, 0, (1,))[at]
        self.words = words & _LAST[np.minimum(ends[self.owner] - at, 8)]

    def hash(self, kind: int = 0) -> np.ndarray:
        """64-bit hashes; those of two kinds are independent. Each word is mixed with its place before they are added."""
        seed = _U(_SEEDS[kind])
        with np.errstate(over="ignore"):
            mixed = mix(mix(self.words + (self.nth.astype(_U) + _U(1)) * seed) ^ seed)
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(mixed)])
            return mix(sums[self.first + self.counts] - sums[self.first] + self.lengths.astype(_U) * seed)


_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LAST = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def segment_hash(data: np.ndarray, starts: np.ndarray, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of each of the segments into which ``starts`` cuts ``data``."""
    return Packed(data, starts, np.append(starts[1:], len(data))).hash(kind) if len(starts) else np.zeros(0, _U)


def prefix_hash(data: np.ndarray, kind: int = 0) -> np.ndarray:
    """Prefix sums from which ``window_hash`` takes the hash of any slice.

    A polynomial modulo 2^64, which texts of a thousand symbols can be built to
    collide under; only for slices shorter than that.
    """
    out = np.zeros(len(data) + 1, _U)
    with np.errstate(over="ignore"):
        np.cumsum(TABLES[kind][data] * POWERS[kind].up(len(data) + 1)[: len(data)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of the slices [start, end); equal slices have equal hashes anywhere."""
    with np.errstate(over="ignore"):
        shifted = (prefix[ends] - prefix[starts]) * POWERS[kind].down(len(prefix))[starts]
        return mix(shifted + (ends - starts).astype(_U))


class Remembered:
    """Values of segments, found by their hash; forgets everything when it grows too large.

    A pure cache: what it forgets is computed again, so its size changes no result.
    An open hash table that is probed for all segments of a block at once. The
    segments themselves are kept and compared, so one that shares its hash with
    another is computed on its own. ``compute`` gets the byte strings of unknown
    segments and returns a list of integer sequences.
    """

    SLOTS = 1 << 21

    def __init__(self, compute: Callable[[list[bytes]], Sequence[Sequence[int]]], kind: type, limit: int = 500_000):
        self.compute, self.kind, self.limit = compute, kind, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, _U)
        self.rows = np.zeros(self.SLOTS, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.kind)
        self.lengths = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.words = np.zeros(0, _U)

    def _probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each hash, or the free slot where its search ends; and whether it is there."""
        mask = _U(len(self.keys) - 1)
        slot = (hashes & mask).astype(np.int64)
        found = self.keys[slot]
        known = found == hashes
        open_ = np.flatnonzero(~known & (found != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(mask)
            found = self.keys[slot[open_]]
            known[open_] = found == hashes[open_]
            open_ = open_[(found != 0) & ~known[open_]]
        return slot, known

    def _insert(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        while len(self.keys) < 3 * (len(self.sizes) + len(hashes)):
            old, kept = self.keys[self.keys != 0], self.rows[self.keys != 0]
            self.keys, self.rows = np.zeros(2 * len(self.keys), _U), np.zeros(2 * len(self.rows), np.int32)
            self._place(old, kept)
        self._place(hashes, rows)

    def _place(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        while len(hashes):
            slot, _ = self._probe(hashes)
            _, first = np.unique(slot, return_index=True)
            self.keys[slot[first]], self.rows[slot[first]] = hashes[first], rows[first]
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            hashes, rows = hashes[rest], rows[rest]

    def _append(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Compute the values of these segments; their rows."""
        raw = data.tobytes()
        values = self.compute([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        rows = np.arange(len(self.sizes), len(self.sizes) + len(values), dtype=np.int32)
        sizes = np.fromiter(map(len, values), np.int32, len(values))
        flat = np.fromiter(chain.from_iterable(values), self.kind, int(sizes.sum()))
        packed = Packed(data, starts, ends)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.first = np.concatenate([self.first, len(self.words) + packed.first])
        self.lengths = np.concatenate([self.lengths, packed.lengths])
        self.words = np.concatenate([self.words, packed.words])
        return rows

    def _differ(self, packed: Packed, rows: np.ndarray) -> np.ndarray:
        """Which segments are not the ones their rows were computed for."""
        other = self.lengths[rows] != packed.lengths
        safe = np.where(other, 0, packed.counts)  # only words of equally long segments can be laid side by side
        inside = np.repeat(~other, packed.counts)
        at = np.repeat(self.first[rows], safe) + packed.nth[inside]
        unequal = self.words[at] != packed.words[inside]
        other[packed.owner[inside][unequal]] = True
        return np.flatnonzero(other)

    def lookup(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The row of ``starts``/``sizes`` that holds the value of each segment."""
        if not len(starts):
            return np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data))
        packed = Packed(data, starts, ends)
        hashes = np.maximum(packed.hash(), _U(1))
        if len(self.sizes) > self.limit:
            self._clear()
        slot, known = self._probe(hashes)
        missing = np.flatnonzero(~known)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            first = missing[first]
            self._insert(new, self._append(data, starts[first], ends[first]))
            slot, _ = self._probe(hashes)
        rows = self.rows[slot]
        odd = self._differ(packed, rows)
        if len(odd):
            rows = rows.copy()
            rows[odd] = self._append(data, starts[odd], ends[odd])
        return rows

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All values of the rows one after another, and how many each has."""
        sizes = self.sizes[rows].astype(np.int64)
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.starts[rows] - before, sizes) + np.arange(int(sizes.sum()))], sizes


WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the row each is in; none crosses a row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~WHITE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of disjoint ascending slices, what lies between them left out."""
    if not len(starts):
        return np.zeros(0, _U)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    packed = data[np.repeat(starts - first, lengths) + np.arange(int(lengths.sum()))]
    return segment_hash(packed, first)
