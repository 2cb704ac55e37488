"""Speculate and verify against the library: ids, decoded texts, the pairwise proof, long words, hostile texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from loomspark.llm import bpe_verify
from loomspark.llm.units import library

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["aa", "a", "ing", "</w>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "É", "é", "ß", "1", "22", "²", "\xa0", "\n", "İ", "\x0b", "\x1c", " ", " ", "<|endoftext", "中文", "😀", "ﬁ", "Σ", "\x00"]


@pytest.fixture(scope="module")
def own():
    return bpe_verify.encoder(PATH)


def hostile(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(0, 90)))
    if kind == 1:
        return "".join(chr(rng.choice([rng.randint(32, 127), rng.randint(0, 0x2FF), rng.randint(0x300, 0xD7FF)])) for _ in range(rng.randint(0, 12)))
    return "".join(rng.choice(ODD) for _ in range(rng.randint(0, 9)))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_are_the_librarys(own):
    rng, lib = random.Random(3), library(PATH)
    texts = [hostile(rng) for _ in range(6000)]
    assert [ids_of(x) for x in own.encode_all(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_pairwise_proof_is_merging(own):
    """For any two reachable tokens: compatible exactly if merging their letters gives the two back."""
    rng, v = random.Random(4), own.words
    tokens = [t for t in v.reachable if ord(t[-1]) < bpe_verify.LAST]
    pairs = [(rng.choice(tokens), rng.choice(list(v.reachable))) for _ in range(200)]
    small = [t for t in tokens if len(t) <= 2 and t.isalpha()]
    pairs += [(rng.choice(small), rng.choice(small)) for _ in range(3000)]
    a, b = ([v.ids[p[k]] for p in pairs] for k in (0, 1))
    got = v.compatible(a, b).tolist()
    assert got == [v.merge(x + y) == [i, j] for (x, y), i, j in zip(pairs, a, b, strict=True)]
    assert 0 < sum(got) < len(got)


def test_both_merges_agree(own):
    rng, v = random.Random(6), own.words
    for n in (1, 2, 5, 40, 300):
        letters = [v.ids[rng.choice("aabcins")] for _ in range(n)]
        assert v.merge_short(list(letters)) == v.merge_long(list(letters))


def test_speculation_fails_and_is_mended(own):
    words = [bpe_verify.last(w) for w in ("unbelievableness", "xqzt", "the", "aaaaaaa", "inthere")]
    ids, mended = own.words.encode(words)
    assert ids == [own.words.merge(w) for w in words]
    assert sum(own.words.propose(w) != i for w, i in zip(words, ids, strict=True)) <= mended < len(words)


def test_long_word_and_slices(own, monkeypatch):
    lib, rng = library(PATH), random.Random(5)
    word = "".join(rng.choice("abcdefgh") for _ in range(40000))
    monkeypatch.setattr(bpe_verify, "SLICE", 50)
    monkeypatch.setattr(bpe_verify, "UNITS", 20)
    texts = [word, " ".join(hostile(rng) for _ in range(300)), "x " * 200, word[:49] + "\n", " " * 120]
    assert [ids_of(x) for x in own.encode_all(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_table(spark):
    rng, lib = random.Random(8), library(PATH)
    texts = [" ".join(hostile(rng) for _ in range(rng.randint(0, 30))).replace("\x00", "") for _ in range(60)] + [None, "", " ", "a", "a"]
    rows = [(i, t, "z", [1]) for i, t in enumerate(texts)] + [(None, "no number", "z", None), (3, "again", "z", [2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids array<int>").repartition(3)
    got = bpe_verify.decode(bpe_verify.encode(docs, PATH), PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = [(d, len(e.ids), e.ids, lib.decode(e.ids, skip_special_tokens=False)) for (d, t, *_), e in zip(rows, lib.encode_batch([r[1] or "" for r in rows], add_special_tokens=False), strict=True)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert bpe_verify.encode(docs.limit(0), PATH).collect() == []
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe_verify.decode(nothing, PATH).first().decoded == ""


def test_query_digests(spark):
    from loomspark.llm.queries import op12_bpe

    sf, lib = "/root/testdata/sf0.001", library(PATH)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False))))
    assert {r.doc_id: tuple(r)[1:] for r in op12_bpe(spark, sf).collect()} == want
