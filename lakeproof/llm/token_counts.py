"""Token counts by a finite-state transducer compiled from a piece vocabulary.

Merging only ever joins neighbouring characters that stand side by side inside
some piece. ``TransducerCounts`` compiles these neighbourhoods into the border
transitions of a deterministic transducer: between two characters that no piece
holds together, the machine returns to its start state and emits the number of
tokens of the segment it has read. The states between borders are the segments'
prefixes; they are made when a text first needs them, and the count on a border
transition is compiled with the vocabulary's merge table, for all new segments
of a block side by side.

A long text is read in chunks. What a chunk does to the machine is a small map:
the open part at its left, the tokens emitted inside, the open part at its right.
Composing two maps is associative, so the maps of a text are combined pairwise,
as in a parallel prefix scan, and no text is ever cut short.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from lakeproof.llm import arrays, frames

DEFAULT = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 18
LONG_SEGMENT = 64

_SPACE = "▁"
_NONE = 1 << 30


@dataclass(frozen=True)
class ChunkMap:
    """What a stretch of text does to the transducer: ``tail`` is None while no border was met."""

    head: bytes
    inner: int
    tail: bytes | None


class TransducerCounts:
    """The compiled transducer of one vocabulary file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [i for i in ids if model.is_unknown(i) or model.is_control(i) or model.is_byte(i)]
        if any(model.is_unused(i) for i in ids):
            raise ValueError("unused pieces are not supported")
        self.prefix = model.encode("a", out_type=str)[0].startswith(_SPACE)
        self.pieces = {model.id_to_piece(i): (i, -model.get_score(i)) for i in set(ids) - set(special)}
        self.byte_fallback = any(model.is_byte(i) for i in ids)
        self.symbols = {p: i for p, (i, _) in self.pieces.items()}
        if not all(c in self.pieces for p in self.pieces for c in p):
            raise ValueError("a piece has a character that is no piece itself")
        self.chars = {c: i for c, i in self.symbols.items() if len(c) == 1}
        self.joins = np.zeros((129, 129), bool)
        rank, left, right, merged = [], [], [], []
        for p, (i, r) in self.pieces.items():
            for k in range(1, len(p)):
                a, b = (min(ord(" " if c == _SPACE else c), 128) for c in (p[k - 1], p[k]))
                self.joins[a, b] = True
                if p[:k] in self.symbols and p[k:] in self.symbols:
                    left.append(self.symbols[p[:k]])
                    right.append(self.symbols[p[k:]])
                    rank.append(r)
                    merged.append(i)
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(key)
        self.pair = key[order]
        _, dense = np.unique(np.array(rank), return_inverse=True)
        self.rank = dense[order].astype(np.int64)
        self.merged = np.array(merged, np.int64)[order]
        self.known = arrays.Remembered(self._compile, np.int32)

    # Compiling border transitions

    def _symbols(self, segment: bytes) -> list[int]:
        """Symbols of a segment; a character outside the vocabulary is minus its tokens."""
        text = segment.decode("utf-8").replace(" ", _SPACE)
        return [self.chars.get(c, -len(c.encode("utf-8")) if self.byte_fallback else -1) for c in text]

    @staticmethod
    def _tokens(symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < 0, -symbols, 1)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], _NONE), self.merged[at]

    def _compile(self, segments: list[bytes]) -> list[list[int]]:
        """Tokens of each segment: in rounds, every unfinished segment makes its best merge."""
        split = [self._symbols(s) for s in segments]
        out = [[0]] * len(segments)
        for i in [i for i, s in enumerate(split) if len(s) > LONG_SEGMENT]:
            out[i] = [self._merge_long(split[i])]
        short = [i for i, s in enumerate(split) if len(s) <= LONG_SEGMENT]
        if not short:
            return out
        symbols = np.array([v for i in short for v in split[i]], np.int64)
        owner = np.repeat(np.arange(len(short)), [len(split[i]) for i in short])
        total = np.zeros(len(short), np.int64)
        while len(symbols):
            rank, merged = self._lookup(symbols[:-1], symbols[1:])
            rank = np.append(np.where(owner[:-1] == owner[1:], rank, _NONE), _NONE)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(owner))))
            done = best == _NONE
            np.add.at(total, owner[done], self._tokens(symbols[done]))
            at = np.flatnonzero((rank == best) & ~done)
            at = at[np.append(True, owner[at][1:] != owner[at][:-1])] if len(at) else at
            symbols[at] = merged[at]
            keep = ~done
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        for i, n in zip(short, total.tolist(), strict=True):
            out[i] = [n]
        return out

    def _merge_long(self, symbols: list[int]) -> int:
        """The same merges with a queue, for segments of any length."""
        table = self._table
        n = len(symbols)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := table.get((symbols[i], symbols[j]))):
                heapq.heappush(queue, (m[0], i, symbols[i], symbols[j], j, m[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b, j, m = heapq.heappop(queue)
            if not (alive[i] and j < n and alive[j] and after[i] == j and symbols[i] == a and symbols[j] == b):
                continue
            symbols[i], alive[j] = m, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return int(self._tokens(np.array([s for s, a in zip(symbols, alive, strict=True) if a], np.int64)).sum())

    @functools.cached_property
    def _table(self) -> dict[tuple[int, int], tuple[int, int]]:
        left, right = (self.pair >> 32).tolist(), (self.pair & 0xFFFFFFFF).tolist()
        return dict(zip(zip(left, right, strict=True), zip(self.rank.tolist(), self.merged.tolist(), strict=True), strict=True))

    # Running the machine

    def borders(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions where segments start; none crosses a row."""
        if not len(data):
            return np.zeros(0, np.int64)
        kind = np.minimum(data, 128)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joins[kind[:-1], kind[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(cut)

    def emit(self, segment: bytes) -> int:
        """The count on the border transition that ends ``segment``."""
        if not segment:
            return 0
        row = int(self.known.lookup(np.frombuffer(segment, np.uint8), np.zeros(1, np.int64))[0])
        return int(self.known.flat[self.known.starts[row]])

    def joined(self, a: bytes, b: bytes) -> bool:
        return bool(self.joins[min(a[-1], 128), min(b[0], 128)])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of two neighbouring stretches."""
        end = a.head if a.tail is None else a.tail
        if self.joined(end, b.head):
            middle, emitted = end + b.head, 0
            if a.tail is None:
                return ChunkMap(middle, b.inner, b.tail)
            if b.tail is None:
                return ChunkMap(a.head, a.inner, middle)
            return ChunkMap(a.head, a.inner + self.emit(middle) + b.inner, b.tail)
        emitted = (0 if a.tail is None else self.emit(a.tail)) + (0 if b.tail is None else self.emit(b.head))
        return ChunkMap(a.head, a.inner + emitted + b.inner, b.head if b.tail is None else b.tail)

    def total(self, maps: list[ChunkMap]) -> int:
        """Tokens of a whole text from its chunks' maps, combined pairwise."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.emit(maps[0].head) + maps[0].inner + self.emit(maps[0].tail or b"")

    def count(self, data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK_BYTES) -> np.ndarray:
        """Tokens of every row; the prefix space must be there already."""
        lengths = np.diff(offsets)
        pieces = np.maximum(1, -(-lengths // chunk))
        row = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.append(offsets[:-1][row] + nth * chunk, offsets[-1])
        for _ in range(3):  # a chunk starts with a whole character
            at[:-1] -= (nth > 0) & ((data[np.minimum(at[:-1], len(data) - 1)] & 0xC0) == 0x80) if len(data) else 0
        totals = np.zeros(len(lengths), np.int64)
        open_maps: dict[int, list[ChunkMap]] = {}
        for i, j in arrays.blocks(at):
            part, edges = data[at[i] : at[j]], at[i : j + 1] - at[i]
            starts = self.borders(part, edges)
            rows = self.known.lookup(part, starts)
            values = self.known.flat[self.known.starts[rows]]
            sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            first = np.searchsorted(starts, edges)
            single = pieces[row[i:j]] == 1
            totals[row[i:j][single]] = (sums[first[1:]] - sums[first[:-1]])[single]
            for k in np.flatnonzero(~single).tolist():
                a, b = int(first[k]), int(first[k + 1])
                ends = [*starts[a + 1 : b].tolist(), int(edges[k + 1])]
                head = part[starts[a] : ends[0]].tobytes()
                tail = part[starts[b - 1] : ends[-1]].tobytes() if b - a > 1 else None
                inner = int(sums[b - 1] - sums[a + 1]) if b - a > 1 else 0
                open_maps.setdefault(int(row[i + k]), []).append(ChunkMap(head, inner, tail))
        for r, maps in open_maps.items():
            totals[r] = self.total(maps)
        return totals

    def prepared(self, texts: pa.Array) -> pa.Array:
        """Texts as the merge process sees them, white space marks written as spaces."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, _SPACE, " ")
        if not self.prefix:
            return texts
        return pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))


@functools.cache
def compiled(path: str) -> TransducerCounts:
    return TransducerCounts(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null text counts as empty: no bytes, no tokens. Ids may be null or repeat,
    each row is answered on its own; an empty table gives an empty result and
    columns other than the two named ones are not read. Texts of any length are
    read whole. One scan, no shuffle.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = frames.plus(source.select("doc_id").schema, "n_bytes long, n_tokens long, over_limit boolean")
    arrow = frames.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            text = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            n = machine.count(*arrays.text_buffer(machine.prepared(text)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), n_bytes, pa.array(n), pa.array(n > limit)], schema=arrow)

    return source.mapInArrow(run, schema)


def default_path() -> str:
    return public_tokenizers.path(DEFAULT)
