"""Texts made to collide under polynomial hashes are told apart by every operator that remembers or counts by hash."""

from __future__ import annotations

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from lakeproof.llm import arrays, bytebpe, language_model, near_duplicates, packing, queries, shingles, token_counts


def thue_morse(n: int, letters: str = "ab") -> str:
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


TWINS = [thue_morse(n, letters) for n in (1024, 2048, 4096) for letters in ("ab", "ba")]


@pytest.fixture(scope="module")
def twins(spark):
    queries.importable(spark)
    return spark.createDataFrame(list(enumerate(TWINS)), "doc_id long, text string").coalesce(1)


def test_hashes_differ():
    for k in range(0, len(TWINS), 2):
        data = np.frombuffer("".join(TWINS[k : k + 2]).encode(), np.uint8)
        for kind in (0, 1):
            a, b = arrays.segment_hash(data, np.array([0, len(data) // 2]), kind)
            assert a != b


def test_a_shared_hash_is_not_a_shared_value(monkeypatch):
    monkeypatch.setattr(arrays.Packed, "hash", lambda self, kind=0: np.full(len(self.lengths), 7, np.uint64))
    known = arrays.Remembered(lambda parts: [list(p) for p in parts], np.int32)
    texts = [b"one", b"two", b"three", b"one", b"twelve letters and more", b"twelve letters and mare"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    for _ in range(2):
        values, sizes = known.gather(known.lookup(data, starts))
        assert [bytes(v.astype(np.uint8)) for v in np.split(values, np.cumsum(sizes)[:-1])] == texts


def test_token_ids_and_counts():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    data = np.frombuffer("".join(TWINS).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, TWINS)])
    ids, counts = bytebpe.load(packing.default_path()).encode(data, offsets)
    for part, text in zip(np.split(ids, np.cumsum(counts)[:-1]), TWINS, strict=True):
        assert part.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    import pyarrow as pa

    machine = token_counts.compiled(token_counts.default_path())
    got = machine.count(*arrays.text_buffer(machine.prepared(pa.array(TWINS))))
    assert got.tolist() == [len(model.encode(t)) for t in TWINS]


def test_shingles_and_counts(spark, twins):
    data = np.frombuffer("".join(TWINS).encode(), np.uint8)
    hashes, bounds = shingles.shingle_sets(data, np.cumsum([0, *map(len, TWINS)]), 4)
    assert np.diff(bounds).tolist() == [1] * len(TWINS) and len(set(hashes.tolist())) == len(TWINS)
    assert all(r.kept for r in near_duplicates.near_duplicates(twins, near_duplicates.Join(words=4)).collect())
    scores = language_model.lm_scores(twins).collect()
    assert {(r.n_words, r.mean_log_score) for r in scores} == {(1, round(float(np.log(1 / len(TWINS))), 6))}


def test_anchors_are_searched_in_stretches_of_a_quarter_megabyte():
    from lakeproof.llm import suffixes

    sizes = [int((end - begin).sum()) for _, _, begin, end in suffixes.slices(np.array([0, 1_500_000]), 200)]
    assert len(sizes) == 6 and max(sizes) <= (1 << 18) + 199
