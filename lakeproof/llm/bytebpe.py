"""Token ids of a byte-level BPE vocabulary, whole blocks of text at a time.

The vocabulary file's own split pattern is applied with array operations; only
pieces not met before are merged one by one.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken

from lakeproof.llm import arrays

DEFAULT = "byte_bpe_50k.json"

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in for each byte in such a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point that the split pattern tells apart."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start() : m.end()]] = kind
    return table


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of the character each byte belongs to, and start and length of those beyond ASCII."""
    kind = np.where(np.arange(256) < 128, _classes()[:256], _OTHER)[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return kind, lead, lead
    size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
    point = data[lead].astype(np.int64) & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
    for k in (1, 2, 3):
        more = size > k
        point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
    group = _classes()[point]
    for k in range(4):
        more = size > k
        kind[lead[more] + k] = group[more]
    return kind, lead, size


def split(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pieces start; none crosses a row of the block."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind, lead, size = _kinds(data)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    # A run of white space gives its last character away, unless it ends the text.
    begins = np.empty(n, bool)
    begins[0] = True
    begins[1:] = (kind[1:] != kind[:-1]) & (data[:-1] != 0x20)
    space = kind == _SPACE
    last = space & ~first[1:]
    last[:-1] &= ~space[1:]
    last[-1] = False
    wide = kind[lead] == _SPACE
    ends = lead[wide] + size[wide]
    last[ends - 1] = False
    ends, at = ends[ends < n], lead[wide][ends < n]
    last[at[~space[ends] & ~first[ends]]] = True
    begins |= last | first[:-1]
    begins &= (data & 0xC0) != 0x80
    # An apostrophe that starts a piece may be a contraction.
    quotes = np.flatnonzero((data == 0x27) & begins)
    if len(quotes):
        left = offsets[np.searchsorted(offsets, quotes, side="right")] - quotes
        follow = lambda k: np.where(left > k, data[np.minimum(quotes + k, n - 1)], 0)
        one, two = follow(1), follow(2)
        taken = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        for pair in ("re", "ve", "ll"):
            taken[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
        for k in (1, 2):
            begins[quotes[taken >= k] + k] = False
        cut = quotes[taken > 0] + taken[taken > 0] + 1
        cut = cut[cut < n]
        begins[cut[kind[cut] == _LETTER]] = True
    return np.flatnonzero(begins)


class ByteBpe:
    """One vocabulary, loaded once in a worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            doc = json.load(f)
        alphabet = _byte_alphabet()
        self.special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        vocab = {t: i for t, i in doc["model"]["vocab"].items() if t not in self.special}
        self.codec = tiktoken.Encoding(
            "vocabulary",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={bytes(alphabet[c] for c in t): i for t, i in vocab.items()},
            special_tokens=self.special,
        )
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.known = arrays.Remembered(self._merge, np.int32)

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        return [self.codec.encode_ordinary(p.decode("utf-8")) for p in pieces]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the number in each row."""
        starts = split(data, offsets)
        rows = self.known.lookup(data, starts)
        ids, sizes = self.known.gather(rows)
        cut = np.searchsorted(starts, offsets)
        ends = np.concatenate([[0], np.cumsum(sizes)])[cut]
        counts = np.diff(ends)
        raw = data.tobytes()
        if not any(t.encode() in raw for t in self.special):
            return ids, counts
        # A special string cuts its text; such rows go through the codec as a whole.
        parts = []
        for i in range(len(counts)):
            text = raw[offsets[i] : offsets[i + 1]]
            if any(t.encode() in text for t in self.special):
                parts.append(np.array(self.codec.encode(text.decode("utf-8"), allowed_special="all"), np.int32))
            else:
                parts.append(ids[ends[i] : ends[i + 1]])
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@functools.cache
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded(path: str, batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of a batch: first and last row, ids, number of ids in each row."""
    bpe = load(path)
    data, offsets = arrays.text_buffer(batch.column(text))
    for i, j in arrays.blocks(offsets):
        part = offsets[i : j + 1]
        ids, counts = bpe.encode(data[part[0] : part[-1]], part - part[0])
        yield i, j, ids, counts
