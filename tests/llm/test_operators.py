"""Every operator against a brute-force version or the library it follows, on small odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeproof.llm import (
    arrays,
    frames,
    language_model,
    line_windows,
    mixing,
    near_duplicates,
    packing,
    quality,
    queries,
    repeats,
    shingles,
    suffixes,
    token_counts,
    training_order,
    vector_graph,
)

ODD = [
    None, "", " ", "\n\n", "a", "it's  we'll\n\n 've 'sabc 's's x'red !'s \n", "x<|endoftext|> y <s> </s>", "é'tü 12३  ½ ▁▁ a▁b",
    "日本語 テスト 😀😀 ", "aaaaaaaaaaaa" * 40, " " * 70, "x\x00y\r\n", "." * 300, "ab" * 300 + "\n" + "=-" * 99, "word " * 3000, "same line\n" * 9,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows and ids, odd texts, and columns whose names clash with the operators' own."""
    queries.importable(spark)
    rows = [(i, t, "en", "s", 1, "k", 5) for i, t in enumerate(ODD)]
    rows += [(None, "null id text of some words", None, None, None, None, None), (3, "once more and again", "de", "t", 1, "k", 5), rows[5], rows[15]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, n_tokens long")


def words_of(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_token_counts_follow_the_library(spark, odd):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    got = Counter(map(tuple, token_counts.token_counts(odd, token_counts.default_path(), limit=50).collect()))
    want = Counter()
    for r in odd.collect():
        n = len(model.encode(r.text or ""))
        want[(r.doc_id, len((r.text or "").encode()), n, n > 50)] += 1
    assert got == want


@pytest.mark.parametrize("chunk", [7, 64])
def test_chunk_maps_compose(chunk):
    machine = token_counts.compiled(token_counts.default_path())
    import pyarrow as pa

    data, offsets = arrays.text_buffer(machine.prepared(pa.array(ODD)))
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    assert machine.count(data, offsets, chunk).tolist() == [len(model.encode(t or "")) for t in ODD]


def test_packing_covers_every_id_once(spark, odd):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(odd.dropDuplicates(["doc_id", "text"]), packing.default_path(), tiers=(16, 32, 64)).collect()
    ids = {}
    for r in odd.dropDuplicates(["doc_id", "text"]).collect():
        ids.setdefault(r.doc_id, []).append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0])
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    for doc, own in ids.items():
        for x in own:
            found = sorted(pieces.pop((doc, len(x))))
            at = 0
            for start, length, crc in found:
                assert start == at and crc == zlib.crc32(np.array(x[start : start + length], "<u4").tobytes())
                at += length
            assert at == len(x)
    assert not pieces
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0


def test_step_groups_are_full_and_of_one_length(spark, odd):
    docs = odd.unionAll(odd).unionAll(odd).repartition(6)
    rows = packing.pack(docs, packing.default_path(), tiers=(16, 32, 64), step_tokens=256).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r.step_group].add((r.tier, r.sequence_id))
    short = Counter()
    for own in groups.values():
        (tier,) = {t for t, _ in own}
        assert len(own) <= 256 // tier
        short[tier] += len(own) < 256 // tier
    assert len(groups) > 5 and all(n <= 1 for n in short.values())


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, x in zip(t, gone, strict=True) if not x)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_repeats_match_brute_force(spark, odd):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(30)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = some(200)
    texts = [r.text for r in odd.collect()] + [base, base[:300] + "Z" + base[301:]]
    for _ in range(40):
        at = rng.randrange(len(base) - 200)
        texts.append(some(rng.randint(1, 40)) + base[at : at + rng.randint(20, 190)] + some(rng.randint(1, 9)))
    df = spark.createDataFrame([(i % 30, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = repeats.remove_repeats(df, suffixes.Shape(40, 10)).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    want = brute_repeats([(t or "").encode() for t in texts], 40)
    assert got == Counter((i % 30, *w) for i, w in enumerate(want))


def test_long_texts_are_searched_in_overlapping_stretches():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    offsets = np.array([0, 3000, 3000, 4000])
    found = {}
    for limit in (256, 1 << 20):
        windows = set()
        for row, base, begin, end in suffixes.slices(offsets, 40, limit):
            own, place, first, last, _, _ = suffixes.anchors(data, begin, end, suffixes.Shape(40, 10))
            for r, b, p, x, y in zip(row[own], base[own], place, first, last, strict=True):
                windows |= {(int(r), int(b + s), int(b + p)) for s in range(x, y + 1)}
        found[limit] = windows
    assert found[256] == found[1 << 20] and len(found[256]) == 3000 - 39 + 1000 - 39


@pytest.mark.parametrize("frequent", [1, 30, 100_000])
def test_language_model_counts_and_backs_off(spark, odd, frequent):
    """Nothing, something and everything is frequent."""
    odd = odd.unionByName(odd.where("doc_id in (3, 9, 14)").withColumn("doc_id", F.col("doc_id") + 100))
    rows = language_model.lm_scores(odd, language_model.Model(frequent=frequent)).collect()
    texts = [words_of(r.text) for r in odd.collect()]
    counts = Counter(tuple(t[i : i + k]) for t in texts for k in (1, 2, 3) for i in range(len(t) - k + 1))
    total = sum(map(len, texts))

    def score(t, i):
        for back, k in enumerate(range(min(3, i + 1), 0, -1)):
            c = counts[tuple(t[i - k + 1 : i + 1])]
            if k == 1:
                return np.log(c / total) + back * np.log(0.4), back
            if c >= 2:
                return np.log(c / counts[tuple(t[i - k + 1 : i])]) + back * np.log(0.4), back

    want = Counter()
    for r, t in zip(odd.collect(), texts, strict=True):
        s = [score(t, i) for i in range(len(t))]
        want[(r.doc_id, len(t), sum(b > 0 for _, b in s), round(float(np.mean([x for x, _ in s])), 4) if s else None)] += 1
    got = Counter((r.doc_id, r.n_words, r.n_backed_off, None if r.mean_log_score is None else round(r.mean_log_score, 4)) for r in rows)
    assert got == want


def test_ngrams_are_counted_and_looked_up_in_lots(spark, odd):
    """No shuffle takes more than a lot of the n-grams, and the lots together give what one pass gives."""
    odd = odd.unionByName(odd.where("doc_id in (3, 9)")).cache()
    whole, lots = (language_model.lm_scores(odd, language_model.Model(frequent=30, whole=w, lots=2)) for w in (10**9, 0))
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, lots.collect()))
    model = language_model.Model(min_count=1)
    every = {r.h: r.c for r in language_model.gram_counts(odd, model, 3).collect()}
    parts = [{r.h: r.c for r in language_model.gram_counts(odd, model, 3, k, 4).collect()} for k in range(4)]
    assert sum(map(len, parts)) == len(every) and {h: c for p in parts for h, c in p.items()} == every
    assert max(map(len, parts)) < 0.5 * len(every)


def test_ngrams_leave_a_task_in_few_rows(spark):
    """One pass counts all lengths; what a stretch of texts has in a bucket is one row, however many n-grams that is."""
    queries.importable(spark)
    docs = spark.range(200, numPartitions=2).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda x: F.concat_ws("-", x, "id"))).alias("text"))
    rows = language_model.gram_parcels(docs, [1, 2, 3], 0, 1, 8).collect()
    assert len(rows) <= 2 * 3 * 8 and Counter(r.size for r in rows).keys() == {1, 2, 3}
    assert {k: sum(sum(r.n) for r in rows if r.size == k) for k in (1, 2, 3)} == {1: 20000, 2: 19800, 3: 19600}
    assert language_model.gram_counts(docs, language_model.Model(), [1, 2, 3]).groupBy("size").count().collect() == [(1, 20000)]


def test_a_document_is_looked_up_in_one_lot(spark):
    """A lot is of documents: their texts are hashed once, and the rows that name them are spread over the buckets."""
    queries.importable(spark)
    docs = spark.range(0, 300, 1, 12).select(F.xxhash64("id").alias("key"), F.concat_ws(" ", F.lit("one two"), F.col("id")).alias("text"))
    nothing = spark.createDataFrame([], "h long, c long").toArrow()
    own = [language_model._asked(docs, nothing, language_model.Model(), k, 3, 64).where("octet_length(keys) > 0").collect() for k in range(3)]
    keys = [[x for r in rows for x in np.frombuffer(r["keys"], np.int64).tolist()] for rows in own]
    assert sorted(sum(keys, [])) == sorted(r.key for r in docs.collect()) and all(keys)
    assert len({r.bucket for r in own[0]}) == len(own[0]) == 12
    assert {x for r in own[0] for x in np.frombuffer(r["n"], np.int32).tolist()} == {3}


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_words_on_the_edge_of_a_stretch_keep_their_ngrams(monkeypatch, order):
    """Every word is new in one stretch, has all n-grams that end with it there, and scores as in one stretch."""
    texts = pa.array(["a b a b a b c", "", "a", None, " ", "b a b c c c a b a", "", "c a b"])
    model = language_model.Model(order=order)

    def scored(stretch):
        monkeypatch.setattr(language_model, "_STRETCH", stretch)
        pieces = [(first, words, n, skip, dict(language_model._chained(words, order))) for first, words, n, skip in language_model._pieces(texts, order)]
        new = [(size, int(x)) for _, _, n, skip, h in pieces for size in h for e, x in enumerate(h[size].tolist(), size - 1)
               if (nth := language_model._nth(n)[e]) >= size - 1 and nth >= np.repeat(skip, n)[e]]
        counts, sums = Counter(new), {}
        for first, words, n, skip, h in pieces:
            nth = language_model._nth(n)
            there = np.array([[counts[size, int(h[size][e - size + 1])] if nth[e] >= size - 1 else 0 for size in h] for e in range(len(words))], np.int64)
            there[there < model.min_count] = 0
            for row, *x in zip(range(first, first + len(n)), *language_model._scored(there.reshape(-1, order), n, skip, 20, model)):
                sums[row] = [a + b for a, b in zip(sums.get(row, [0, 0, 0]), x)]
        return counts, {row: [round(float(x), 9) for x in y] for row, y in sums.items()}

    whole = scored(1 << 19)
    assert sorted(whole[1]) == [*range(8)] and [whole[1][r][1] for r in range(8)] == [7, 0, 1, 0, 0, 9, 0, 3]
    assert all(scored(stretch) == whole for stretch in (1, 2, 3, 5, 7, 19))


def test_buckets_follow_the_ngrams_alone(spark):
    queries.importable(spark)
    docs = spark.range(400).select(F.col("id").alias("key"), F.concat_ws(" ", *[F.concat(F.lit(w), "id") for w in "abcdefgh"]).alias("text"))
    table = spark.createDataFrame([(1, 2, 0.5)], "h long, c long, gain double")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        asked = language_model._asked(docs.repartition(1), table.toArrow(), language_model.Model(), 0, 1, language_model._buckets())
        assert asked.count() <= 2 * 64
        sums = language_model.gram_sums(docs, table, 3200, language_model.Model(), 0, 1)
        assert Counter((r.words, r.hits) for r in sums.collect()) == {(8, 0): 400}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_shuffle_files_go_when_a_settled_job_ends(spark):
    kept = spark._jsc.sc().env().blockManager().diskBlockManager()
    made = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.collect_list("id").alias("ids"))
    before = set(kept.getAllBlocks().mkString(" ").split())
    rows, path = frames.settled(made, "settled")
    after = set(kept.getAllBlocks().mkString(" ").split())
    assert rows.count() == 100 and not [f for f in after - before if f.startswith("shuffle")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    frames.remove(spark, path)


def test_repeated_rows_are_each_answered(spark, monkeypatch):
    queries.importable(spark)
    monkeypatch.setattr(language_model, "_COPIES", 4)
    docs = spark.range(11).select(F.lit(7).alias("doc_id"), F.lit("one two one two").alias("text"))
    rows = language_model.lm_scores(docs.unionByName(spark.createDataFrame([(7, "two")], "doc_id int, text string"))).collect()
    assert Counter((r.n_words, r.n_backed_off) for r in rows) == {(4, 0): 11, (1, 0): 1}
    assert len({r.mean_log_score for r in rows}) == 2


@pytest.mark.parametrize("order", [1, 2])
def test_lower_orders(spark, order):
    queries.importable(spark)
    docs = spark.createDataFrame([(1, "a b a b"), (2, "b c"), (3, None)], "doc_id int, text string")
    got = {r.doc_id: r.mean_log_score for r in language_model.lm_scores(docs, language_model.Model(order=order)).collect()}
    single = {w: np.log(n / 6) for w, n in (("a", 2), ("b", 3), ("c", 1))}
    one = [single["a"], single["b"], single["a"], single["b"]]
    two = [single["a"], np.log(2 / 2), np.log(0.4) + single["a"], np.log(2 / 2)]
    last = single["c"] + (np.log(0.4) if order == 2 else 0)
    assert got == {1: round(float(np.mean(two if order == 2 else one)), 6), 2: round(float(np.mean([single["b"], last])), 6), 3: None}


def brute_near(rows, size):
    sets = []
    for _, text in rows:
        w = words_of(text, lower=True)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 80 * len(sets[i] | sets[k]):
                parent[root(i)] = root(k)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("settings", [{}, {"node_limit": 40, "max_depth": 1}])
def test_near_duplicates_match_brute_force(spark, odd, settings):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for g in range(120):
        own = list(base) if g % 2 else [rng.choice(vocabulary) for _ in range(rng.randint(3, 60))]
        for _ in range(2):
            copy = list(own)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((100 + len(rows), " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicates(df, near_duplicates.Join(words=4, **settings)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_trees_reach_the_target():
    """4,200 classes that share a passage, in pairs over the threshold: as many trees as their depth asks for miss none."""
    join = near_duplicates.Join(words=1)
    below = sum(join.equal[: join.least_equal])
    assert all(join.missed(join.trees_for(d), d) + below <= join.miss for d in range(2, 3 + join.max_depth))
    passage, texts = [f"p{k}" for k in range(30)], []
    for g in range(2100):
        own = [f"g{g}w{k}" for k in range(20)]
        texts += [" ".join(passage + own), " ".join(passage + own[5:] + [f"g{g}x{k}" for k in range(5)])]
    raw = [t.encode() for t in texts]
    h, bounds = shingles.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]), join.words)
    sig = shingles.signatures(h, bounds, join.signature)
    assert ((sig[::2] == sig[1::2]).sum(1) >= join.least_equal).all()
    depth, met, missed = 6, np.zeros(2100, bool), {}
    for tree in range(join.trees_for(depth)):
        row, path = np.arange(4200), np.full(4200, arrays.mix(np.array([tree + 1], np.uint64))[0])
        for _ in range(depth):
            more, path = near_duplicates._children(path, sig[row])
            row = row[more]
        nodes = defaultdict(set)
        for r, x in zip(row.tolist(), path.tolist(), strict=True):
            nodes[r].add(x)
        met |= [bool(nodes[2 * g] & nodes[2 * g + 1]) for g in range(2100)]
        missed[tree + 1] = int((~met).sum())
    assert missed[join.trees] > 0 == missed[join.trees_for(depth)]


def test_keep_one_leaves_one_of_each_group(spark, odd):
    kept = near_duplicates.keep_one(odd)
    rows = kept.collect()
    assert kept.columns == odd.columns
    assert len(rows) == len({(r.doc_id, r.text) for r in rows}) and len(rows) < odd.count()


def test_keep_one_keeps_unrelated_texts_of_one_id(spark):
    """Repeated and null ids: components are told apart by their texts."""
    texts = [" ".join(f"t{i}w{k}" for k in range(40)) for i in range(9)]
    near = texts[0] + " end"
    rows = [(5, texts[0]), (5, texts[1]), (6, near), (None, near), *((None, t) for t in texts[2:6]), (7, texts[6]), (None, texts[6]), (None, texts[7]), (None, texts[7] + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text.split(" end")[0]) for r in near_duplicates.keep_one(docs).collect())
    assert got == Counter([(5, texts[0]), (5, texts[1]), *((None, t) for t in texts[2:6]), (7, texts[6]), (None, texts[7])])


def brute_lines(rows):
    where = []
    lines = {}
    for d, text in rows:
        key = (d is not None, d, text or "")
        kept = [(i, x) for i, x in enumerate((text or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]
        lines[key] = kept
    order = sorted(lines, key=lambda k: (k[0], k[1] or 0, k[2]))
    seen, gone = set(), defaultdict(set)
    for key in order:
        kept = lines[key]
        for p in range(len(kept) - 2):
            w = tuple(x for _, x in kept[p : p + 3])
            if w in seen:
                gone[key] |= {i for i, _ in kept[p : p + 3]}
            seen.add(w)
    for d, text in rows:
        key = (d is not None, d, text or "")
        left = "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in gone[key]) if gone[key] else text
        where.append((d, len(lines[key]), len(gone[key]), left))
    return Counter(where)


def test_line_windows_match_brute_force(spark, odd):
    rng = random.Random(5)
    pool = ["one", "two", " ", "three", "four", "", "five"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_windows.line_dedup(df).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == brute_lines(rows)


def test_word_statistics(spark, odd):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.word_statistics(odd).collect())
    want = Counter()
    for r in odd.collect():
        text, w = r.text or "", words_of(r.text)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if words_of(x)]
        want[(r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))] += 1
    assert got == want


def test_decision_list_holds_out_of_sample(spark):
    """Learned without a fifth of the labels, judged on that fifth."""
    docs, labels = (frames.read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(5)) == 0
    statistics = frames.materialise(quality.word_statistics(docs), "test-quality")
    rules = quality.learn(frames.materialise(quality.labelled_bins(statistics, labels.where(~held)), "test-bins"))
    judged = quality.apply_rules(statistics, rules).join(labels.where(held).select("doc_id", "quality"), "doc_id")
    hits, total = judged.where("not base_failed").agg(F.sum(((F.col("rule") == 0) == (F.col("quality") == 1)).cast("int")), F.count(F.lit(1))).collect()[0]
    assert total > 500 and hits / total > 0.98


def test_no_labels_no_rules(spark, odd):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.quality_rules(odd, empty).collect()
    assert len(rows) == odd.count() and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.keep_good(odd, empty).columns == odd.columns


def test_mixing_budgets_and_prefixes(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    levels = {"language": F.col("lang"), "origin": F.col("source")}
    weights = {"language": {"en": 1.0, "de": 8.0}, "origin": {"a": 3.0}}
    got = mixing.mixture(df, levels, weights, 0.6, max_epochs=2).collect()
    size = Counter()
    for r in got:
        size[r.language, r.origin] += r.n_tokens

    def share(budget, children):  # water level by bisection
        low, high = 0.0, 1e9
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(c, mid * w) for c, w in children.values()) < budget else (low, mid)
        return {k: min(c, high * w) for k, (c, w) in children.items()}

    langs = {x: (2 * sum(v for (a, _), v in size.items() if a == x), weights["language"].get(x, 1.0)) for x in {a for a, _ in size}}
    for lang, budget in share(0.6 * sum(size.values()), langs).items():
        leaves = {o: (2 * v, weights["origin"].get(o, 1.0)) for (a, o), v in size.items() if a == lang}
        for origin, quota in share(budget, leaves).items():
            own = [r for r in got if (r.language, r.origin) == (lang, origin)]
            assert abs(own[0].quota - quota) <= 2
            used = sum(r.n_tokens * r.n_copies for r in own)
            assert used <= own[0].quota and own[0].quota - used <= 30
            assert max(r.n_copies for r in own) - min(r.n_copies for r in own) <= 1


def test_mixing_takes_the_prefix_of_the_order(spark, odd):
    """Every copy is the one that walking each leaf's rows in the order of their epoch gives."""
    queries.importable(spark)
    mixed = mixing.mixture(odd, {"language": F.col("lang"), "origin": F.col("source")}, {"language": {"en": 3.0}}, 0.7, max_epochs=2)
    clashing = mixing.mixture(odd.withColumns({"quota": F.lit("q"), "n_copies": F.lit("c")}), {"language": F.col("lang"), "origin": F.col("source")}, {"language": {"en": 3.0}}, 0.7, max_epochs=2)
    assert Counter(map(str, clashing.select(mixed.columns).collect())) == Counter(map(str, mixed.collect()))
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    orders = [F.xxhash64(F.lit(7), F.lit(epoch), key).alias(f"epoch{epoch}") for epoch in (0, 1)]
    leaves = defaultdict(list)
    for r in mixed.select("language", "origin", "n_tokens", "quota", "n_copies", *orders).collect():
        leaves[r.language, r.origin].append(r)
    assert len(leaves) == 3 and any(0 < r.n_copies for rows in leaves.values() for r in rows)
    for rows in leaves.values():
        quota, total = rows[0].quota, sum(r.n_tokens for r in rows)
        full = quota // total if total else 0
        rows.sort(key=lambda r: r[f"epoch{min(full, 1)}"])
        spent, taken = 0, []
        for r in rows:
            spent += r.n_tokens
            taken.append(spent <= quota - full * total)
        # Equal rows share their place: they go together with the last of them.
        last = {r[f"epoch{min(full, 1)}"]: t for r, t in zip(rows, taken, strict=True)}
        assert [r.n_copies for r in rows] == [full + last[r[f"epoch{min(full, 1)}"]] for r in rows]


def test_rules_match_a_plain_learner(spark):
    """Sequential covering over rows in lists, against the aggregations over bins."""
    rng, names = random.Random(5), list(quality.FEATURES)
    rows = []
    for _ in range(900):
        bins = {n: rng.randint(0, 6) for n in names}
        bad = bins[names[0]] >= 5 or (bins[names[1]] < 2 and bins[names[2]] >= 4)
        rows.append((bins, bad != (rng.random() < 0.04), rng.random() < 0.33))
    frame = spark.createDataFrame([(*b.values(), bad, prune, 1) for b, bad, prune in rows], [*(f"bin_{n}" for n in names), "bad", "prune", "n"])
    settings = quality.LearnerSettings()

    def covers(rule, bins):
        return all((bins[f] >= t) if above else (bins[f] < t) for f, above, t in rule)

    def grow(grown, banned):
        best = None
        p0, n0 = sum(bad for _, bad, _ in grown), sum(not bad for _, bad, _ in grown)
        for f in names:
            values = sorted({b[f] for b, _, _ in grown})
            for t in values[1:] if f not in banned else []:
                for above in (False, True):
                    held = [bad for b, bad, _ in grown if covers([(f, above, t)], b)]
                    p, n = sum(held), len(held) - sum(held)
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
                    if p >= settings.min_covered and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, (f, above, t))
        return best and best[1]

    left, want, banned = rows, [], set()
    while len(want) < settings.max_rules:
        rule = []
        while len(rule) < settings.max_conditions:
            grown = [r for r in left if not r[2] and covers(rule, r[0])]
            if len({r[1] for r in grown}) < 2 or (condition := grow(grown, set() if rule else banned)) is None:
                break
            rule.append(condition)
        if not rule:
            break
        scores = []
        for k in range(1, len(rule) + 1):
            held = [bad for b, bad, prune in left if prune and covers(rule[:k], b)]
            scores.append(((sum(held) + 1) / (len(held) + 2), -k, sum(held), len(held)))
        _, k, p, n = max(scores)
        if not p or p / n < settings.min_precision:
            banned.add(rule[0][0])
            continue
        want.append(rule[:-k])
        left = [r for r in left if not covers(rule[:-k], r[0])]
    rules = quality.learn(frame, settings)
    assert [[(c.feature, c.above, c.threshold) for c in r] for r in rules] == want and len(want) > 1


def test_learning_reads_labelled_documents_only(spark, odd):
    docs, labels = (frames.read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    kept = quality.quality_rules(docs, labels).where("kept").select("doc_id").collect()
    assert Counter(kept) == Counter(quality.keep_good(docs, labels).select("doc_id").collect())


def test_training_order_is_a_permutation_and_a_round_trip(spark, odd):
    for n in (1, 2, 7, 64, 1000):
        assert sorted(training_order.Feistel(n, 5).slots(np.arange(n)).tolist()) == list(range(n))
    path = training_order.default_path()
    shards = sorted(training_order.training_shards(odd, path, length=16, per_shard=8).collect())
    raw = b"".join(r.payload for r in shards)
    assert [r.first_slot for r in shards] == [8 * i for i in range(len(shards))] and all(r.stride == 32 for r in shards)
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for r in odd.collect():
        want.update([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 50256])
    got = Counter(np.frombuffer(raw, "<u2").tolist())
    assert got - want == Counter({50256: got[50256] - want[50256]}) and not want - got


def test_training_order_is_that_of_the_network(spark, odd):
    path = training_order.default_path()
    tokenizer = Tokenizer.from_file(path)
    docs = odd.coalesce(1)
    stream = []
    for r in docs.collect():
        stream += [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 50256]
    cut = [stream[i : i + 16] for i in range(0, len(stream), 16)]
    cut[-1] += [50256] * (16 - len(cut[-1]))
    n = len(cut)
    half = (max(n - 1, 1).bit_length() + 1) // 2

    def slot(x):
        while True:
            left, right = x >> half, x & ((1 << half) - 1)
            for k in training_order.Feistel(n, 11).keys:
                mixed = int(training_order.arrays.mix(np.array([right], np.uint64) ^ k)[0])
                left, right = right, left ^ (mixed & ((1 << half) - 1))
            x = left << half | right
            if x < n:
                return x

    want = [None] * n
    for i, ids in enumerate(cut):
        want[slot(i)] = ids
    shards = sorted(training_order.training_shards(docs, path, length=16, per_shard=4).collect())
    assert [r.shard for r in shards] == list(range(-(-n // 4)))
    got = np.frombuffer(b"".join(r.payload for r in shards), "<u2").reshape(-1, 16).tolist()
    assert got == want


def test_a_stopped_reader_goes_on(spark, odd, tmp_path):
    shards = training_order.training_shards(odd, training_order.default_path(), length=16, per_shard=4)
    training_order.write_shards(shards, str(tmp_path / "order"))
    stored = spark.read.parquet(str(tmp_path / "order"))
    raw = b"".join(r.payload for r in sorted(stored.collect()))
    n = len(raw) // 32
    for at in (0, 1, 4, n // 2, n - 1):
        rest = training_order.read_from(stored, at, 4).collect()
        assert b"".join(r.payload[r.from_byte :] for r in rest) == raw[32 * at :]
    assert training_order.read_from(stored, n, 4).collect() == []
    with pytest.raises(ValueError):
        training_order.read_from(stored, -1, 4)
    ranges = stored.groupBy(F.input_file_name()).agg(F.min("shard").alias("a"), F.max("shard").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:], strict=False))
    nothing = training_order.training_shards(odd.where("false"), training_order.default_path())
    training_order.write_shards(nothing, str(tmp_path / "none"))
    assert training_order.read_from(spark.read.schema(nothing.schema).parquet(str(tmp_path / "none")), 0, 4).collect() == []


def test_intersections_match_sets():
    rng = np.random.default_rng(2)
    for n, few, width in ((1, 2, 4), (40, 3, 5), (90, 48, 2048), (60, 1, 7)):
        template = rng.integers(0, 1 << 63, 30)
        sets = [np.unique(np.concatenate([template, rng.integers(0, 200, rng.integers(0, 60))])) if i % 7 else np.zeros(0, np.int64) for i in range(n)]
        sets += [sets[-1]]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        got = shingles.intersections(np.concatenate(sets).astype(np.uint64), bounds, few, width)
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_pairs_in_a_template_are_linked_alone(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    template = [word() for _ in range(150)]
    rows = []
    for i in range(700):
        own = [word() for _ in range(100)]
        rows.append((2 * i, " ".join(template + own)))
        rows.append((2 * i + 1, " ".join(template + own[:-2] + [word()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in range(1400)}


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.05 * (i % 4)).tolist(), i % 3) for i in range(240)]
    rows += [(240, None, 1), (241, [0.0] * 16, 1), (242, [float("nan")] * 16, 1), (243, [1.0] * 15 + [None], 1), (244, rows[0][1], None)]
    rows += [(245 + i, rows[5][1], rows[5][2]) for i in range(30)] + [(None, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    good = [r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    unit = np.array([np.array(r[1]) / np.linalg.norm(r[1]) if g else np.zeros(16) for r, g in zip(rows, good, strict=True)])
    label = np.array([r[2] if g else -1 - i for i, (r, g) in enumerate(zip(rows, good, strict=True))])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = Counter((r[0], int(n)) for r, n in zip(rows, near.sum(1), strict=True))
    for graph in (vector_graph.Graph(), vector_graph.Graph(shard=4, block=10, max_levels=1)):
        got = vector_graph.near_vectors(df, graph).collect()
        if graph.shard > 4:
            assert Counter((r.vec_id, r.n_links) for r in got) == want
        else:
            assert sum(r.n_links for r in got) >= 0.9 * near.sum()
    found = vector_graph.near_vectors(df)
    hits, total = vector_graph.audit_recall(df.where("vec_id is not null"), found.where("vec_id is not null"), every=7)
    assert hits >= 0.9 * total > 0


def test_vector_links_across_shards(spark):
    """Pairs just over the threshold, split over several levels: both are in the primary cell of either."""
    rng = np.random.default_rng(6)
    graph = vector_graph.Graph(cosine=0.995, shard=100, block=80)
    one, turn = rng.normal(size=(2, 500, 4))
    one /= np.linalg.norm(one, axis=1)[:, None]
    turn -= (one * turn).sum(1)[:, None] * one
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    angle = 0.97 * np.arccos(graph.cosine)
    unit = np.vstack([one, one * np.cos(angle) + turn * np.sin(angle)])
    near = unit @ unit.T >= graph.cosine
    np.fill_diagonal(near, False)
    classes = spark.createDataFrame([(str(i), v.tolist(), 1, 0) for i, v in enumerate(unit)], "cid string, unit array<double>, n int, label int")
    cells = [(r.cell, int(r.cid), r.primary) for r in vector_graph._cells(classes, graph).select("cell", "cid", "primary").collect()]
    assert max(c.count("/") for c, _, _ in cells) >= 2
    members, home = defaultdict(set), {i: c for c, i, primary in cells if primary}
    for c, i, _ in cells:
        members[c].add(i)
    assert len(home) == len(unit) == sum(primary for _, _, primary in cells)
    assert all(set(np.flatnonzero(near[i])) <= members[c] for i, c in home.items())
    vectors = classes.select(F.col("cid").cast("long").alias("vec_id"), F.col("unit").alias("embedding"), "label")
    got = {r.vec_id: r.n_links for r in vector_graph.near_vectors(vectors, graph).collect()}
    assert [got[i] for i in range(len(unit))] == near.sum(1).tolist()


def test_vector_graph_leaves_dense_groups():
    """Groups of more near-equal vectors than a row has candidates, beside each other; equal directions; an island."""
    rng = np.random.default_rng(8)
    axes = np.eye(32)
    side = 0.99 * axes[0] + np.sqrt(1 - 0.99**2) * axes[1]
    groups = [centre + rng.normal(size=(100, 32)) * 1e-4 for centre in (axes[0], side)]
    unit = np.vstack([*groups, axes[2] + rng.normal(size=(250, 32)) * 1e-4, np.repeat(axes[3:4], 90, 0)])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    graph = vector_graph.Graph()
    links = vector_graph.build(unit, graph)
    assert not vector_graph.islands([set(x) for x in links]).any()
    medoid = int(np.argmax(unit @ unit.mean(0)))
    assert 200 <= medoid
    near = unit @ unit.T >= graph.cosine
    np.fill_diagonal(near, False)
    assert near[:100, 100:200].all()
    assert [x.tolist() for x in vector_graph.search(unit, links, medoid, graph)] == [np.flatnonzero(x).tolist() for x in near]


def test_empty_tables(spark, odd):
    empty = odd.limit(0)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = packing.default_path()
    results = [
        repeats.remove_repeats(empty), language_model.lm_scores(empty), packing.pack(empty, path), vector_graph.near_vectors(vectors),
        token_counts.token_counts(empty, token_counts.default_path()), quality.quality_rules(empty, labels), line_windows.line_dedup(empty),
        near_duplicates.near_duplicates(empty), mixing.mixture(empty, queries.tree(), queries.WEIGHTS, 0.5), training_order.training_shards(empty, path),
    ]
    assert [r.count() for r in results] == [0] * 10


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    from tests.oracle import expected

    rows = queries.QUERIES[name](spark, sf_dir)
    order = sorted(rows.columns)
    assert Counter(tuple(r[c] for c in order) for r in rows.collect()) == expected(sf_dir, queries.ORACLES[name])[1]


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = frames.read(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = frames.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_stages_take_odd_tables(spark, odd, sf_dir, rows):
    """Each stage by itself over null ids, null and empty texts, repeated rows and clashing columns, and over nothing."""
    import corpus_pipeline

    wordy = spark.createDataFrame([(50 + i // 2, " ".join(f"w{k * (i // 4 + 1) % 1009}" for k in range(300))) for i in range(8)], "doc_id long, text string")
    docs = odd.unionByName(wordy, allowMissingColumns=True) if rows == "odd" else odd.limit(0)
    given = Counter(map(str, docs.drop("text", "n_chars").collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got = out.collect()
        assert Counter(str(r) for r in out.drop("text", "n_chars").collect()) <= given and bool(got) == bool(given), name
        if name == "quality_rules":
            assert all(len(words_of(r.text)) >= 50 for r in got)
        if name == "line_dedup":
            assert len(got) == docs.count() and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
        if name == "near_dedup" and got:
            assert sum(not words_of(r.text) for r in got) >= sum(not words_of(t) for t in ODD)
            assert sum(r.doc_id is not None and r.doc_id >= 50 for r in got) == 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
