"""Best-fit packing, the Merkle manifest and hard negatives against brute force, on small odd inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeproof.llm import best_fit, hard_negatives, merkle, midstates, queries, residue_product
from tests.llm.test_operators import ODD
from tests.oracle import expected


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows and ids, odd texts, and columns whose names clash with the operators' own."""
    queries.importable(spark)
    rows = [(i, t, ["en", None, "de", "é", "e"][i % 5], "s", i, "k", 5) for i, t in enumerate(ODD)]
    rows += [(None, "null id text of some words", None, None, None, "k", 5), (3, "once more and again", "de", "t", 1, "k", 5), rows[5], rows[15]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size int")


@pytest.fixture
def ranges(spark):
    """Several tasks to every sort, however few the rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Best-fit packing


def best_fit_descending(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_sweep_takes_the_successor():
    draw = random.Random(3)
    for _ in range(200):
        rows = sorted(((draw.randint(0, 1), draw.randint(1, 6)) for _ in range(draw.randint(0, 14))), key=lambda r: (-r[1], r[0]))
        kind, size = np.array([k for k, _ in rows], int), np.array([s for _, s in rows], int)
        taken = best_fit.sweep(kind, size)
        free = []
        for i, (k, s) in enumerate(rows):
            if k == 0:
                free.append(s)
            elif free:
                assert rows[taken[i]] == (0, min(free)) and min(free) >= s
                free.remove(min(free))
            else:
                assert taken[i] == -1
        used = taken[taken >= 0]
        assert len(set(used.tolist())) == len(used)


def test_ranges_meet_by_rank():
    stretches, matched = best_fit.across({0: 1, 2: 5}, {0: 2, 1: 2}, opened=1)
    assert matched == 4
    assert [(s.task, s.low, s.high, s.gap_task, s.gap_rank) for s in stretches] == [(0, 0, 1, None, None), (2, 0, 2, 1, 1), (2, 2, 4, 0, 1)]


def check_packing(rows, docs, fit, tokenizer):
    sequences, wanted = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(placed)))
        assert [o for o, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= fit.capacity
    lengths = []
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, fit.separator]
        first = len(ids) % fit.capacity or fit.capacity
        bounds = [0, *range(first, len(ids) + 1, fit.capacity)] if len(ids) > fit.capacity else [0, len(ids)]
        for piece, (a, b) in enumerate(itertools.pairwise(bounds)):
            wanted[(d.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
            lengths.append(b - a)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    return len(sequences), best_fit_descending(lengths, fit.capacity)


@pytest.mark.parametrize("range_rows", [8, 1 << 16])
def test_best_fit_packs_odd_texts(spark, odd, range_rows):
    tokenizer = Tokenizer.from_file(best_fit.default_path())
    fit = best_fit.Fit(capacity=64, range_rows=range_rows)
    got, best = check_packing(best_fit.pack(odd, best_fit.default_path(), fit).collect(), odd.collect(), fit, tokenizer)
    assert got <= best + 1


@pytest.mark.parametrize("range_rows", [100, 1 << 16])
def test_best_fit_with_a_hot_length(spark, range_rows):
    queries.importable(spark)
    draw = random.Random(5)
    texts = ["a" + " a" * 9] * 300 + [" a" * draw.randint(1, 70) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fit = best_fit.Fit(capacity=64, range_rows=range_rows)
    got, best = check_packing(best_fit.pack(docs, best_fit.default_path(), fit).collect(), docs.collect(), fit, Tokenizer.from_file(best_fit.default_path()))
    assert got <= 1.02 * best


# Merkle manifest


def test_midstates_follow_the_library():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    words = midstates.words(b"".join(digests))
    state, count = midstates.fresh(40), np.arange(40) % 4
    for k in range(3):
        rows = np.flatnonzero(count > k)
        state[rows] = midstates.absorb(state[rows], words[(rows + k) % 40])
    got = midstates.finish(state, count)
    for i, n in enumerate(count.tolist()):
        text = "".join(digests[(i + k) % 40].hex() for k in range(n))
        assert midstates.packed(got[i : i + 1]) == hashlib.sha256(text.encode()).digest()


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves: list[str], arity: int) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def walk(levels: list[list[str]], at: int, value: str, arity: int) -> tuple[str, str]:
    siblings = ""
    for level in levels[:-1]:
        low = at - at % arity
        run = level[low : low + arity]
        siblings += "".join(run[: at - low] + run[at - low + 1 :])
        run[at - low] = value
        value, at = H("".join(run)), at // arity
    return value, siblings


def manifest_by_hand(docs, arity: int) -> Counter:
    spell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, n: H("".join(map(spell, (d.doc_id, d.source, d.lang, n, d.text))))
    groups = defaultdict(list)
    for d in docs:
        tampered = d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None
        groups[d.lang].append((d.doc_id, leaf(d, d.n_chars), leaf(d, d.n_chars + 1) if tampered else None))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([x[1] for x in groups[g]], arity)
    top = tree([trees[g][-1][0] for g in names], arity)
    out = Counter()
    for k, g in enumerate(names):
        for i, (doc_id, own, other) in enumerate(groups[g]):
            sub, low = walk(trees[g], i, other or own, arity)
            root, high = walk(top, k, sub, arity)
            out[(doc_id, own, trees[g][-1][0], top[-1][0], H(low + high), root, root == top[-1][0])] += 1
    return out


def manifest(docs, shape):
    tampers = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"n_chars": F.try_add("n_chars", F.lit(1))}, tampers, shape=shape)


@pytest.mark.parametrize(("arity", "levels"), [(2, 12), (2, 2), (3, 1)])
def test_manifest_matches_brute_force(spark, odd, ranges, arity, levels):
    got = Counter(map(tuple, manifest(odd, merkle.Shape(arity, levels)).collect()))
    assert got == manifest_by_hand(odd.collect(), arity)
    assert {v[-1] for v in got} == {True, False}


@pytest.mark.parametrize("n", [1, 5, 9])
def test_manifest_of_one_group(spark, n):
    queries.importable(spark)
    rows = [(i, "text", "en", "s", None) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(map(tuple, manifest(docs, merkle.Shape(2, 1)).collect())) == manifest_by_hand(docs.collect(), 2)


# Hard negatives


@pytest.mark.parametrize(("width", "size"), [(0, 5), (1, 5), (64, 256), (2500, 1 << 20)])
def test_residue_products_are_exact(width, size):
    draw = np.random.default_rng(width)
    a, b = (draw.integers(-size, size + 1, (n, width)) for n in (7, 11))
    assert (residue_product.product(a, b) == a.astype(object) @ b.astype(object).T).all()
    top = np.full((1, width), size)
    assert int(residue_product.product(top, -top)[0, 0]) == -width * size * size


def mined_by_hand(rows, mining) -> Counter:
    takes_part = []
    for i, (vec_id, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        takes_part.append((i, vec_id, label, [int(np.floor(mining.scale * float(x))) for x in e]))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = Counter()
    for i, anchor, label, x in takes_part:
        if anchor is None or anchor % 50:
            continue
        others = [(sum(map(int.__mul__, x, y)), v, k, m) for k, v, m, y in takes_part if k != i and len(y) == len(x)]
        for p in sorted((o for o in others if o[3] == label), key=order)[: mining.positives]:
            band = [o for o in others if o[3] != label and mining.low * p[0] <= 100 * o[0] <= mining.high * p[0]]
            for rank, n in enumerate(sorted(band, key=order)[: mining.negatives], 1):
                out[(anchor, p[1], rank, n[1], p[0], n[0])] += 1
    return out


@pytest.mark.parametrize("mining", [hard_negatives.Mining(), hard_negatives.Mining(anchor_rows=2, block_rows=13)])
def test_hard_negatives_match_brute_force(spark, mining):
    queries.importable(spark)
    draw = np.random.default_rng(4)
    near = lambda: [float(np.float32(x)) for x in draw.normal(0.3, 0.4, 8)]
    rows = [(int(i), near(), int(draw.integers(3))) for i in range(120)]
    rows += [(200, None, 1), (250, [float("nan")] * 8, 1), (300, [None] * 8, 1), (350, near(), None), (400, [], 1), (401, [], 2), (402, [], 1)]
    rows += [(450, [0.5, 0.5], 1), (451, [0.5, 0.4], 1), (452, [0.4, 0.4], 0), (None, near(), 1), (None, near(), 2), (500, [float("inf")] * 8, 2)]
    rows += [(600, rows[0][1], 1), *[(601 + i, rows[0][1], i % 3) for i in range(9)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit(1)).withColumn("row", F.lit("x")).coalesce(1)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, mining, label=label)
    assert Counter(map(tuple, got.collect())) == mined_by_hand(rows, mining)
    again = hard_negatives.hard_negatives(frame.unionAll(frame.where("vec_id = 50")), F.col("vec_id") % 50 == 0, mining, label=label)
    assert Counter(map(tuple, again.collect())) == mined_by_hand([*rows, next(r for r in rows if r[0] == 50)], mining)


# All three


def test_empty_tables(spark, odd):
    nothing = odd.where("false")
    assert best_fit.pack(nothing, best_fit.default_path()).collect() == []
    assert manifest(nothing, merkle.Shape()).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("name", ["op12_merkle", "op13_hard_negatives"])
def test_oracles(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    _, want = expected(sf_dir, queries.ORACLES[name])
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == want
