"""Spelling variants against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from loomspark.llm import spelling


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs):
    total = Counter()
    for ident, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def plain(docs):
    n = plain_words(docs)
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], -1)) for w in n)


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_trie_gives_all_pairs():
    rng = random.Random(1)
    for alphabet, most in (("ab", 8), ("abcdé", 6), ("a", 12)):
        words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(150)})
        got = list(spelling.Trie(words).near())
        want = {(i, j) for i, j in itertools.permutations(range(len(words)), 2) if one_apart(words[i], words[j])}
        assert len(got) == len(set(got))
        assert set(got) == want


def test_trie_of_long_words():
    stem = "x" * 30000
    words = sorted([stem, stem + "a", stem[:-1] + "y", "y" + stem[1:], stem[:100]])
    assert len(list(spelling.Trie(words).near())) == 6


def made(rng):
    letters = "abcdeé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["shared" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    words = stems + [w[:i] + rng.choice(["", "a", "é", w[i : i + 1] * 2]) + w[i + 1 :] for w in stems * 3 for i in [rng.randrange(len(w))]]
    docs = [(i, " ".join(rng.choice([str.upper, str.lower, str.title])(rng.choice(words)) for _ in range(200)) + ", ÉÀ×÷ x1y2") for i in range(25)]
    return docs + [(90, None), (91, ""), (92, "... 123"), (None, "aaaaab aaaaab AAAAAB aaaaac"), docs[3], docs[3], (93, "z" * 5000 + " ") , (94, ("z" * 5000 + " ") * 3 + ("z" * 5001 + " ") * 3)]


@pytest.mark.parametrize("cell", [20000, 3])
def test_against_all_pairs(spark, cell, monkeypatch):
    """With cells of three words, nearly all go down letter by letter."""
    rng = random.Random(2)
    monkeypatch.setattr(spelling, "SLICE", 64)
    docs = made(rng) if cell > 3 else made(rng)[:12]
    table = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    got = rows_of(spelling.variants(table, cell=cell))
    assert got == plain(docs)
    assert any(r[1] for r in got)
    assert any(r[2] != r[0] and r[2] != r[1] for r in got) or cell == 3


def test_roots_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(70)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.roots(links).collect()} == {(f"w{i:03}", "w070") for i in range(70)}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "1 2")], "doc_id long, text string")).collect() == []


def test_slices_cut_between_words(monkeypatch):
    text = "Abc déf" * 40 + " end"
    whole = [w for part in spelling.runs(text) for w in part]
    monkeypatch.setattr(spelling, "SLICE", 7)
    assert [w for part in spelling.runs(text) for w in part] == whole


def test_query_and_sql(spark):
    import duckdb

    from loomspark.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = queries.op11_spelling(spark, sf)
    rel = con.sql(queries.SQL["op11_spelling"])
    assert sorted(rel.columns) == sorted(got.columns)
    want = plain([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()])
    cols = ("word", "form", "root", "n", "n_near", "form_n")
    assert rows_of(got) == want == sorted((r[0], r[1] or "", *r[2:5], -1 if r[5] is None else r[5]) for r in rel.select(*cols).fetchall())
