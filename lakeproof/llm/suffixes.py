"""Sampled suffixes of byte texts: where windows anchor, and what they share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from lakeproof.llm import arrays

_U = np.uint64
_PLACE = _U((1 << 21) - 1)
SLICE = 1 << 18


@dataclass(frozen=True)
class Shape:
    """Length of a repeated string and of the anchor inside it."""

    length: int = 200
    anchor: int = 50

    @property
    def reach(self) -> int:
        """How many places an anchor can take in a window."""
        return self.length - self.anchor + 1


def slices(offsets: np.ndarray, length: int, limit: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of stretches to search at once: row, first byte in the row, begin and end in the buffer.

    A long text is cut into stretches that overlap by all but one byte of a
    window, so every window lies in exactly one stretch.
    """
    size = np.diff(offsets)
    rows = np.flatnonzero(size >= length)
    starts = size[rows] - length + 1
    pieces = -(-starts // limit)
    row = np.repeat(rows, pieces)
    base = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * limit
    begin = offsets[row] + base
    end = np.minimum(begin + limit + length - 1, offsets[row + 1])
    ends = np.concatenate([[0], np.cumsum(end - begin)])
    for i, j in arrays.blocks(ends, limit):
        yield row[i:j], base[i:j], begin[i:j], end[i:j]


def anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """For stretches of ``data``: which stretch, anchor place, first and last window start, anchor hash, hull hash.

    The anchor of a window is the place in it whose following ``anchor`` bytes
    hash lowest, the leftmost if several do. It depends on the window's bytes
    alone, so equal windows have equal anchors at equal places; windows next to
    each other mostly share one, and come out as one row. Places are counted
    from the stretch's begin. The hull of a row is what its windows cover.
    """
    lengths = end - begin
    at = np.cumsum(lengths) - lengths
    flat = np.concatenate([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
    prefix = arrays.prefix_hash(flat)
    places = np.arange(len(flat) - shape.anchor + 1)
    hashes = arrays.window_hash(prefix, places, places + shape.anchor)
    low = sliding_min((hashes & ~_PLACE) | places.astype(_U), shape.reach)
    chosen = (low & _PLACE).astype(np.int64)
    # Windows that lie inside one stretch.
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(chosen)]
    valid = np.arange(len(chosen)) + shape.length <= (at + lengths)[owner]
    fresh = np.append(True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(valid & fresh)
    stop = np.append(first[1:], len(chosen))
    # A row's windows end before the next row begins or before windows stop being valid.
    stop = np.minimum(stop, (at + lengths - shape.length + 1)[owner[first]])
    last = stop - 1
    place = chosen[first]
    other = arrays.prefix_hash(flat, 1)
    hull = arrays.window_hash(other, first, last + shape.length, 1)
    with np.errstate(over="ignore"):
        hull = arrays.mix(hull + (place - first).astype(_U) * _U(0x9E3779B97F4A7C15))
    own = owner[first]
    return own, place - at[own], first - at[own], last - at[own], hashes[place], hull


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima over blocks of that width from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])
