"""SHA-256 chaining states of many messages side by side.

A digest as hex text is 64 bytes, exactly one block, so the state between two
child slots of a parent is one chaining value of 32 bytes: it can be kept in a
table and resumed anywhere. The constants are those of FIPS 180-4, made by its
rule: fractional parts of the roots of the first primes.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_PRIMES = [n for n in range(2, 312) if all(n % q for q in range(2, isqrt(n) + 1))]


def _cube_root(n: int) -> int:
    """The integer part."""
    x = 1 << -(-n.bit_length() // 3)
    while (y := (2 * x + n // x**2) // 3) < x:
        x = y
    return x


_K = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n, 8) after a block each; a block is sixteen words (16, n) or, shared by all, (16, 1)."""
    w = list(block)
    a, b, c, d, e, f, g, h = state.T
    with np.errstate(over="ignore"):
        for t in range(64):
            if t >= 16:
                x, y = w[t - 15], w[t - 2]
                s0 = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
                s1 = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
                w.append(w[t - 16] + s0 + w[t - 7] + s1)
            t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + _K[t] + w[t]
            t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
            a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
        return state + np.stack([a, b, c, d, e, f, g, h], 1)


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States after the hex text of a digest each; digests are (n, 8) words."""
    raw = np.ascontiguousarray(digests.astype(">u4")).view(np.uint8)
    text = np.empty((len(raw), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[raw >> 4], _HEX[raw & 15]
    return compress(state, np.ascontiguousarray(text.view(">u4").astype(np.uint32).T))


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks that led to these states."""
    out = np.empty_like(state)
    for n in np.unique(blocks).tolist():
        pad = np.zeros((16, 1), np.uint32)
        pad[0], pad[14], pad[15] = 0x80000000, (512 * n) >> 32, (512 * n) & 0xFFFFFFFF
        rows = np.flatnonzero(blocks == n)
        out[rows] = compress(state[rows], pad)
    return out


def fresh(n: int) -> np.ndarray:
    return np.repeat(START[None, :], n, 0)


def words(raw: bytes | np.ndarray) -> np.ndarray:
    """Binary digests or states one after another as (n, 8) words."""
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype(">u4")).tobytes()
