"""The pipeline's near-copy stage against all pairs."""

import itertools
import os
import random

import pytest

import corpus_pipeline
from loomspark.llm import simhash
from loomspark.llm.near_copies import shingles, similarity


def plain_kept(rows):
    """Identifiers that stay: the smallest of each group of rows linked by similarity."""
    own = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(own)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(own)), 2):
        a, b = own[i][1], own[j][1]
        if 10 * min(a.size, b.size) >= 8 * max(a.size, b.size) and similarity(a, b) >= 0.8:
            root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(own):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted(d for i, (d, *_) in enumerate(own) if d == least[find(i)])


def test_similarity():
    words = [f"w{i}" for i in range(24)]
    assert shingles(" ".join(words)).size == 20
    assert similarity(shingles("A b\tC d  e"), shingles("a B c D E")) == 1.0
    # a set of 20 shingles against its first 16 is 0.8 exactly
    assert similarity(shingles(" ".join(words)), shingles(" ".join(words[:20]))) == 0.8


def test_stage_takes_near_copies_of_many_bits(spark):
    rng = random.Random(7)
    rows = []
    for g in range(30):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 300]))]
        for k in range(4):
            own = list(words)
            for _ in range(k * len(words) // 100):
                own[rng.randrange(len(own))] = f"e{rng.randrange(3000)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(500, None), (501, " "), (502, "one two"), (503, "One  two"), (504, "one three")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows] + [(None, rows[0][1], "y")], "doc_id long, text string, lang string").repartition(3)
    got = corpus_pipeline.without_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == plain_kept(rows)
    assert sum(r.doc_id is None for r in got) == 1
    far = [(a, b) for a, b in itertools.combinations(rows[:120], 2) if similarity(shingles(a[1]), shingles(b[1])) >= 0.8 and (simhash.fingerprint(a[1]) ^ simhash.fingerprint(b[1])).bit_count() > 4]
    assert far


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_stage_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id is not null").dropDuplicates(["doc_id"])
    got = corpus_pipeline.without_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == plain_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_stage(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert corpus_pipeline.without_near_copies(spark, docs, "").collect() == []


def test_passage_shared_by_many_unlike_texts(spark, monkeypatch):
    """One passage decides keys of many texts; only the few similar ones are compared, and all of them are found."""
    from loomspark.llm import near_copies

    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(45))
    rows = [(d, f"{passage} " + " ".join(f"d{d}w{k}" for k in range(rng.randrange(20, 40)))) for d in range(120)]
    rows += [(200 + d, rows[d][1] + " more") for d in range(0, 120, 10)]  # similar to one each
    rows += [(300 + d, passage + f" end{d}") for d in range(6)]  # the passage with one word more: similar among themselves
    compared = []
    plain = near_copies.checked
    monkeypatch.setattr(near_copies, "checked", lambda pairs, *rest: compared.append(pairs.count()) or plain(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_copies.near_dedup(docs)
    assert sorted(r.doc_id for r in got.collect()) == plain_kept(rows)
    assert compared[1] <= 40, compared  # out of thousands of pairs that share the passage


def test_prefixes_lose_no_pair(spark):
    """Without any help of keys: all similar pairs of different groups share a prefix shingle."""
    from loomspark.llm import near_copies

    rng = random.Random(13)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.choice([6, 12, 30]))] for _ in range(25)]
    texts = [" ".join(w) for w in base] + [" ".join(w[:i] + [f"x{rng.randrange(5)}"] + w[i + 1 :]) for w in base for i in [rng.randrange(len(w))]] + ["one two", "one two three"]
    own = {i: shingles(t) for i, t in enumerate(texts)}
    groups = spark.createDataFrame([(i, int(s.size), i) for i, s in own.items()], "fp long, n long, root long")
    table = spark.createDataFrame(list(enumerate(texts)), "fp long, text string")
    got = {(r.a, r.b) for r in near_copies.by_prefixes(groups, table, 5, 0.8).collect()}
    want = {(a, b) for a in own for b in own if a > b and similarity(own[a], own[b]) >= 0.8}
    assert want and want <= got and len(got) < len(texts) ** 2 / 8


def reached(links, nodes):
    """Each node's smallest reachable one."""
    root = {x: x for x in nodes}
    while True:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def test_stage_links_fingerprints_by_pigeonring(spark):
    """All classes within the wider budget are joined, and none beyond it."""
    from loomspark.llm import near_copies

    rng = random.Random(21)
    bits = []
    for _ in range(60):
        base = rng.getrandbits(64)
        bits += [base, base] + [base ^ sum(1 << p for p in rng.sample(range(64), k)) for k in (1, 5, 6, 7, 8, 12)]
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    links = [(r.a, r.b) for r in near_copies.by_bits(spark.createDataFrame(list(enumerate(signed)), "fp long, bits long")).collect()]
    near = [(i, j) for i, j in itertools.combinations(range(len(bits)), 2) if (bits[i] ^ bits[j]).bit_count() <= 7]
    assert near_copies.MAX_BITS == 7 and all(a > b for a, b in links)
    assert reached(links, range(len(bits))) == reached(near, range(len(bits)))


@pytest.mark.parametrize("block", [1 << 18, 4000])
def test_loose_group_makes_no_rows_of_pairs(spark, monkeypatch, block):
    """Of texts about as similar as the bound, what prefixes leave numbers as the texts and not as their pairs, in one block or several."""
    from loomspark.llm import near_copies

    rng = random.Random(22)
    base, rows = [f"w{k}" for k in range(200)], []
    for d in range(80):
        own = list(base)
        for p in rng.sample(range(5, 195), 2 if d % 2 else 4):
            own[p] = f"d{d}p{p}"
        rows.append((d, " ".join(own)))
    seen, plain = [], near_copies.checked
    monkeypatch.setattr(near_copies, "checked", lambda candidates, *rest: seen.append(candidates.count()) or plain(candidates, *rest))
    monkeypatch.setattr(near_copies, "BLOCK", block)
    got = near_copies.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = plain_kept(rows)
    assert sorted(r.doc_id for r in got.collect()) == want and 1 < len(want) < len(rows)
    # the first are at most a bucket's members less one, of 48 keys a text
    assert len(seen) == 2 and seen[0] <= len(rows) * (len(rows) - 1) / 4 and seen[1] <= len(rows)
