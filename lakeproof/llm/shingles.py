"""Word shingles of whole texts: sets of hashes, fingerprints and minwise signatures."""

from __future__ import annotations

import numpy as np

from lakeproof.llm import arrays

_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted within the row, and where each row's begin.

    A-Z count as a-z. A row with fewer words than ``size`` has its whole
    sequence as its one shingle; a row without words has none.
    """
    upper = (data >= 0x41) & (data <= 0x5A)
    starts, ends, row = arrays.word_spans(data, offsets)
    words = arrays.span_hash(data + upper.astype(np.uint8) * np.uint8(32), starts, ends)
    n = np.bincount(row, minlength=len(offsets) - 1) if len(row) else np.zeros(len(offsets) - 1, np.int64)
    first = np.cumsum(n) - n
    # One shingle starts at each word that has enough words after it, or else at the first.
    nth = np.arange(len(words)) - first[row]
    begins = np.flatnonzero((nth + size <= n[row]) | (nth == 0))
    owner = row[begins]
    length = np.minimum(size, n[owner])
    with np.errstate(over="ignore"):
        h = np.zeros(len(begins), _U)
        for k in range(size):
            inside = k < length
            h[inside] = arrays.mix(h[inside] * _U(0xD6E8FEB86659FD93) + words[begins[inside] + k] + _U(k + 1))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])) if len(h) else np.zeros(0, bool)
    h, owner = h[fresh], owner[fresh]
    return h, np.searchsorted(owner, np.arange(len(offsets)))


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, which do not depend on order; 0 for empty sets."""
    out = []
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(arrays.mix(hashes ^ _U(seed)))])
            out.append(sums[bounds[1:]] - sums[bounds[:-1]])
    return out[0], out[1]


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """``count`` minwise values (32 bits) of each set; all ones for empty sets."""
    out = np.full((len(bounds) - 1, count), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    short = (hashes >> _U(32)).astype(np.uint32)
    seeds = arrays.mix(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    values = np.empty_like(short)
    for j, seed in enumerate(seeds):
        np.bitwise_xor(short, np.uint32(seed & _U(0xFFFFFFFF)), out=values)
        np.multiply(values, np.uint32((seed >> _U(32)) | _U(1)), out=values)
        out[full, j] = np.minimum.reduceat(values, bounds[full])
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def intersections(h: np.ndarray, bounds: np.ndarray, few: int = 48, width: int = 2048) -> np.ndarray:
    """Sizes of the intersections of every two of the sets h[bounds[i]:bounds[i + 1]].

    Shingles that the same sets hold are one, with a weight. Those of up to
    ``few`` sets add to their pairs one by one; the others are columns of a
    matrix, multiplied ``width`` at a time. All sums are exact.
    """
    n = len(bounds) - 1
    both = np.zeros((n, n), np.int32)
    order = np.argsort(h, kind="stable")
    owner = np.repeat(np.arange(n), np.diff(bounds))[order]
    starts = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
    held_by = np.diff(np.concatenate([starts, [len(h)]]))
    exact = np.float32 if len(h) < 1 << 24 else np.float64
    block, weights = np.zeros((n, width), exact), np.zeros(width, exact)
    used = 0

    def multiply() -> None:
        both[...] += np.rint((block[:, :used] * weights[:used]) @ block[:, :used].T).astype(np.int32)

    for d in np.unique(held_by[held_by > 1]).tolist():
        sets = owner[starts[held_by == d][:, None] + np.arange(d)]
        sets, weight = np.unique(sets, axis=0, return_counts=True)
        if d <= few:
            x, y = np.triu_indices(d, 1)
            step = max(1, (1 << 21) // len(x))
            for at in range(0, len(sets), step):
                some = sets[at : at + step]
                np.add.at(both, (some[:, x], some[:, y]), weight[at : at + step, None].astype(np.int32))
                np.add.at(both, (some[:, y], some[:, x]), weight[at : at + step, None].astype(np.int32))
            continue
        for own, w in zip(sets, weight.tolist(), strict=True):
            block[own, used], weights[used] = 1, w
            used += 1
            if used == width:
                multiply()
                block[...], used = 0, 0
    if used:
        multiply()
    both[np.arange(n), np.arange(n)] = np.diff(bounds)
    return both
