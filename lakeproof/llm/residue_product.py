"""Exact integer matrix products in float32, by residues modulo small primes."""

from __future__ import annotations

import numpy as np

# Balanced residues of a prime below 256 are at most 127 in size, so a thousand
# products of two add up below 2^24, where float32 is still exact.
_TERMS = 1000


def _primes_below(n: int) -> list[int]:
    return [p for p in range(n - 1, 2, -1) if all(p % q for q in range(2, int(p**0.5) + 1))]


PRIMES = _primes_below(256)


def moduli(bound: int) -> list[int]:
    """As many primes, the largest first, as tell all integers of size up to ``bound`` apart."""
    out, product = [], 1
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound:
            return out
    raise OverflowError("the bound is beyond the product of all primes")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p-1)/2 and (p-1)/2."""
    r = np.mod(x, p)
    return r - p * (r > p // 2)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integer matrices, exact wherever the result fits 64 bits.

    For every prime the residue matrices are multiplied in float32, in stretches
    short enough to be exact. The digits of the result in the mixed radix of the
    primes follow one after another (Garner's form of the Chinese remainder
    theorem); taken balanced, they give the sign as well.
    """
    width = a.shape[1]
    if not width or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    bound = width * int(np.abs(a).max()) * int(np.abs(b).max())
    out = np.zeros((len(a), len(b)), np.int64)
    radix = 1
    for p in moduli(bound):
        x, y = _balanced(a, p).astype(np.float32), _balanced(b, p).astype(np.float32)
        residue = np.zeros(out.shape, np.float32)
        for at in range(0, width, _TERMS):
            part = x[:, at : at + _TERMS] @ y[:, at : at + _TERMS].T
            residue = np.fmod(residue + np.fmod(part, np.float32(p)), np.float32(p))
        # The next digit is what is missing to the residue, divided by the radix so far.
        missing = _balanced(residue.astype(np.int64) - np.mod(out, p), p)
        digit = _balanced(missing * pow(radix, -1, p), p)
        with np.errstate(over="ignore"):
            out += digit * np.array(radix & (1 << 64) - 1, np.uint64).astype(np.int64)
        radix *= p
    return out
