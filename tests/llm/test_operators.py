"""The operators against plain versions, with nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from loomspark.llm import common, exact_dedup, language_id, mixing, order_minhash, page_text, piece_lattice, simhash, subword_lm, token_counts, token_store

SCHEMA = "doc_id long, text string, lang string, source string, slot string, fp int, keep_id double"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def corpus():
    rng = random.Random(5)
    vocab = ["".join(rng.choice(["th", "er", "an", "é", "ß", "ing", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts += [texts[0], texts[0], texts[1].replace(" ", "  ", 3) + "\n end.", "", None, " ", "\n", "A  b\tC\n\nd ", "x" * 700, "<|endoftext|> a<|endoftext|>b", "中文 😀 ✓", texts[2] + " more", "!!! ??? 123", "one"]
    langs = ["en" if i % 2 else "fr" for i in range(len(texts))]
    rows = [(i * 3, t, langs[i], None if i % 7 == 0 else f"s{i % 5}", "x", 1, 0.5) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no number here", None, "s1", "y", 2, 0.1)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    for keep, best in (("max", max), ("min", min)):
        want = Counter()
        for t, ids in groups.items():
            k = best((i for i in ids if i is not None), default=None)
            for i in ids:
                want[i, k, len(ids), i == k, hashlib.sha256(t.encode()).hexdigest()] += 1
        assert bag(exact_dedup.exact_classes(docs, keep=keep)) == want
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(groups.keys())


def test_exact_dedup_finds_false_merges(spark):
    runs = spark.createDataFrame([(0, b"d", 1, 1, 5, 7), (0, b"d", 2, 1, 6, 7)], "at int, digest binary, keep_id long, group_size long, n_bytes long, proof long")
    with pytest.raises(Exception, match="different texts"):
        exact_dedup._merge(runs, "max").collect()


def plain_fingerprint(text, k=4):
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(items, bits=4):
    """{fp: smallest reachable}"""
    fps = sorted(items)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= bits:
            root[find(a)] = find(b)
    least = {}
    for f in fps:
        least[find(f)] = min(least.get(find(f), items[f]), items[f])
    return {f: least[find(f)] for f in fps}


def test_simhash(docs, rows):
    first = {}
    for r in rows:
        f = plain_fingerprint(r[1])
        if r[0] is not None:
            first[f] = min(first.get(f, r[0]), r[0])
        else:
            first.setdefault(f, 1 << 60)
    want = plain_components(first)
    got = simhash.components(docs).collect()
    assert len(got) == len(rows)
    for r, (d, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        f = plain_fingerprint(t)
        assert r.doc_id == d and r.fingerprint == f"{f:016x}"
        assert r.component_id == (None if want[f] == 1 << 60 else want[f])
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("chain", [2, 3, 4])
def test_pigeonring_loses_no_link(spark, chain):
    """Dense and sparse groups of fingerprints, with small blocks: components equal those of all pairs."""
    rng = random.Random(chain)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(40):
            f = base
            for _ in range(rng.randint(0, 6)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = dict(simhash.contract(simhash.links(df, chain=chain, block=16)).collect())
    want = plain_components({f: f - (1 << 64) if f >> 63 else f for f in fps})
    assert {f: roots.get(f, f) for f in signed} == {f - (1 << 64) if f >> 63 else f: v for f, v in want.items()}


def test_every_pair_within_budget_passes_the_chain():
    rng = np.random.default_rng(3)
    x = np.zeros(20000, np.uint64)
    for k in range(4):
        x ^= np.uint64(1) << rng.integers(0, 64, x.size, dtype=np.uint64)
    assert simhash._pass(x).all()
    far = rng.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert (simhash._pass(far) == (np.bitwise_count(far) <= 4)).all()


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * w[s] / sum(w[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mix(docs, rows, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    sizes = defaultdict(int)
    n = lambda t: len((t or "").encode().split())
    for r in rows:
        sizes[r[3]] += n(r[1])
    want = plain_targets(dict(sizes))
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((r[0], n(r[1]), r[3]) for r in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-5
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert sum(n(r.text) for r in mixed.collect()) == sum(r.taken for r in got)


def test_better_documents_are_taken_sooner(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    more = docs.unionByName(docs.select(F.col("doc_id") + 4000, "text", F.lit("t").alias("source")).withColumnRenamed("(doc_id + 4000)", "doc_id"))
    q = more.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    got = mixing.mix(more, quality=q).where("source = 't'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("c")).collect()
    share = {r.odd: r.c for r in got}
    assert share[0] > share[1] + 0.2


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    want = Counter((r[0], len((r[1] or "").encode()), k := len(tok.encode(r[1] or "", add_special_tokens=False).ids), k > 2048) for r in rows)
    assert bag(token_counts.token_counts(docs, WORDS)) == want
    assert bag(token_counts.token_counts(docs, WORDS, chunk=40, overlap=4)) == want


def test_resynchronisation(rows):
    from tokenizers import Tokenizer

    tok, rng = Tokenizer.from_file(WORDS), random.Random(1)
    texts = [r[1] for r in rows if r[1]]
    for i in range(60):
        text = "".join(rng.choice(texts) + rng.choice(["", " ", "\n", "'s ", "x" * 50]) for _ in range(4))
        for chunk, overlap in ((30, 3), (100, 10), (1000, 50)):
            assert token_counts.long_ids(tok, text, chunk, overlap) == tok.encode(text, add_special_tokens=False).ids


def test_token_store(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    path = str(tmp_path / "store")
    token_store.write(docs, path, BYTES)
    got = token_store.read(spark, path).orderBy("start").collect()
    streams = {}
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        streams[r.start] = (r.doc_id, r.n_tokens, r.ids_crc32)
    want = Counter((r[0], zlib.crc32(np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for r in rows)
    assert Counter((d, c) for d, _, c in streams.values()) == want
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r[0] for r in rows if r[0] is not None)
    for r in token_store.read_ids(spark, path).collect():
        ids = np.array(r.ids, "<u4").tobytes()
        assert (r.doc_id, len(r.ids), zlib.crc32(ids)) == streams[r.start]
    keys = [r.key for r in token_store.chunks_of(spark, path).collect()]
    assert len(keys) == len(set(keys))


def test_token_store_chunks():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50000, 30000).astype("<u4")
    cuts = token_store.cut_points(ids)
    sizes = np.diff([0, *cuts])
    assert cuts[-1] == len(ids) and sizes.max() <= token_store.MAX_IDS and sizes[:-1].min() >= token_store.MIN_IDS
    moved = token_store.cut_points(np.concatenate((ids[:100], ids)))
    assert len({c - 100 for c in moved} & set(cuts)) > 0.8 * len(cuts)
    assert token_store.cut_points(np.zeros(5000, "<u4"))[-1] == 5000
    for body in (ids[:1], ids[:300], np.array([1, 2, 3], "<u4"), np.array([70000, 1], "<u4")):
        assert (token_store.widened(*token_store.narrowed(body)) == body).all()


def test_token_store_holds_few_texts_at_a_time(spark):
    """However many texts a batch brings, ids and chunks of ``ROWS`` of them are held; the encoder is that of any batch."""
    import pyarrow as pa

    n = 2 * token_store.ROWS + 3
    whole = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"text number {i % 5}" for i in range(n)])], names=["doc_id", "text"])
    got = list(token_store.stored(iter([whole]), BYTES, 0))
    recipes = [[d for k, d in zip(b["kind"].to_pylist(), b["doc_id"].to_pylist(), strict=True) if k == "recipe"] for b in got]
    assert [len(r) for r in recipes] == [token_store.ROWS, token_store.ROWS, 3] and sum(recipes, []) == list(range(n))
    assert sum(k == "chunk" for b in got for k in b["kind"].to_pylist()) == 5


def test_small_batches(spark):
    """Texts reach Python workers a few MB at a time, one larger than that alone; the session's setting comes back."""

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["rows", "bytes"])

    rows = spark.range(0, 6000, 1, 1).select(F.when(F.col("id") == 3000, F.repeat(F.lit("0123456789"), common.BATCH // 8)).otherwise(F.repeat(F.lit("0123456789"), 300)).alias("text"))
    before = spark.conf.get(common.BATCH_BYTES, None)
    with common.small_batches(spark):
        got = rows.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 6000 and max(r.bytes for r in got if r.rows > 1) < 3 * common.BATCH
    assert spark.conf.get(common.BATCH_BYTES, None) == before


def test_token_store_notices_damage(spark, docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write(docs.limit(5), path, BYTES)
    bad = spark.read.parquet(f"{path}/objects").where("kind = 'chunk'").withColumn("body", F.concat(F.lit(b"\x00\x01"), F.col("body"))).cache()
    bad.count()
    n = spark.read.parquet(f"{path}/layout").first()[0]
    rows = bad.select("key", "n", "width", "body").repartition(n, "key").write.mode("overwrite").option("path", f"{path}/objects/kind=chunk")
    rows.bucketBy(n, "key").sortBy("key").saveAsTable("damaged_chunks")
    spark.sql("DROP TABLE damaged_chunks")
    with pytest.raises(Exception, match="damaged"):
        token_store.read(spark, path).collect()


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    rows = [(2, " ".join(words), "a"), (1, " ".join(swapped), "a"), (0, " ".join(words), "a")]
    got = {r.doc_id: r for r in order_minhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, sig string")).collect()}
    assert got[2].fingerprint == got[0].fingerprint and 0.3 < got[2].near_next < 0.8
    assert got[0].near_next == 1.0


def test_language_id(spark, docs, rows):
    rng = random.Random(1)
    syll = {"en": ["th", "ing", "ou", "er"], "fr": ["é", "eau", "qu", "oi"]}
    made = []
    for i in range(400):
        lang = rng.choice(["en", "fr"])
        made.append((i, " ".join("".join(rng.choice(syll[lang]) for _ in range(3)) for _ in range(30)), lang))
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language_id.train(df, sample=200)
    assert model.languages == ["en", "fr"] and 0 < (model.weights != 0).mean() < 0.05
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    for i, _, lang in made:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang and 0.5 < got[i].score <= 1
    again = language_id.train(df.repartition(5), sample=200)
    assert np.array_equal(again.weights, model.weights) and again.temperature == model.temperature
    odd = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    for r in rows:
        if r[1] is None or not any(map(str.isalpha, r[1])):
            assert (odd[r[0]].lang_pred, odd[r[0]].score) == ("und", 0.0)
    kept = language_id.select_known(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == sum(bool(r[1]) and any(map(str.isalpha, r[1])) for r in rows)


def plain_viterbi(unit, scores, worst):
    best = [(0.0, [])]
    for b in range(1, len(unit) + 1):
        ways = []
        for a in range(max(0, b - 16), b):
            s = scores.get(unit[a:b], worst if b - a == 1 else None)
            if s is not None:
                ways.append((best[a][0] + s, best[a][1] + [unit[a:b]]))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1]


def test_pieces(spark, docs, rows):
    sp = piece_lattice.model(PIECES)
    got = piece_lattice.encode(docs, PIECES)
    want = Counter((r[0], tuple(sp.encode(r[1] or ""))) for r in rows)
    out = got.collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in out) == want
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in out)
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    back = piece_lattice.decode(got.where("doc_id is not null").dropDuplicates(["doc_id"]), PIECES).collect()
    assert {r.doc_id: r.text for r in back} == texts


def test_viterbi(spark):
    rows, _ = piece_lattice.pieces(PIECES)
    scores, ids = {p: s for p, _, s in rows}, {i: p for p, i, _ in rows}
    worst = min(scores.values()) - 10.0
    units = ["▁the", "▁thanedble", "▁ingen.", "é", "▁xqzzy", "▁a"]
    found = piece_lattice.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), PIECES, "viterbi")
    got = {r.unit: [ids[i] if i >= 0 else chr(-1 - i) for i in r.tokens] for r in found.collect()}
    for u in units:
        total, path = plain_viterbi(u, scores, worst)
        assert "".join(got[u]) == u and sum(scores.get(p, worst) for p in got[u]) == pytest.approx(total)


def all_segmentations(word, scores):
    if not word:
        yield 0.0
    for k in range(1, min(16, len(word)) + 1):
        if word[:k] in scores:
            for rest in all_segmentations(word[k:], scores):
                yield scores[word[:k]] + rest


def test_lattice_marginal():
    weights = subword_lm.first_weights(PIECES)
    index = subword_lm.vocabulary_index(PIECES)
    names = [p for p, *_ in piece_lattice.pieces(PIECES)[0]]
    scores = {p: math.log(weights[i + 1]) for i, p in enumerate(names)}
    words, lengths = ["the", "thanedble", "a", "ingen"], np.array([0] + [len(p) for p in names])
    for part, ids, bare in subword_lm.lattices(words, index):
        logs, shares = subword_lm.forward(ids, bare, weights, True)
        edges = subword_lm.expected(ids, shares)
        for i, w in enumerate(part):
            ways = list(all_segmentations("▁" + words[w], scores))
            assert logs[i] == pytest.approx(math.log(sum(math.exp(x) for x in ways)))
            assert (edges[i] * lengths[ids[i]]).sum() == pytest.approx(len(words[w]) + 1)
    for _, ids, bare in subword_lm.lattices(["😀𐍈" * 40, "", "a" * 3000], index):
        assert np.isfinite(subword_lm.forward(ids, bare, weights)[0]).all()


def plain_scores(rows, rounds, tokens, out):
    """The model as its module describes it, with dictionaries: score by row."""
    names = [p for p, *_ in piece_lattice.pieces(PIECES)[0]]
    first = dict(zip(names, subword_lm.first_weights(PIECES)[1:].tolist(), strict=True))
    sizes = Counter(r[2] or "" for r in rows if not out(r[0]))
    large = [g for g, k in sorted(sizes.items(), key=lambda x: (-x[1], x[0])) if k >= subword_lm.LEAST_SHARE * sizes.total()]
    group = lambda g: large.index(g or "") if (g or "") in large else len(large)
    groups = range(len(large) + 1)
    counts, ends = [Counter() for _ in groups], [0] * len(groups)
    for r in rows:
        if not out(r[0]):
            counts[group(r[2])].update(tokens(r[1])[:-1])
            ends[group(r[2])] += 1
    every = sum(counts, Counter())
    n, n_ends = every.total() + sum(ends), sum(ends)

    def edges(word, p):
        """[(start, end, piece, weight)] with bare characters."""
        text = "▁" + word
        found = [(a, b, text[a:b], p[text[a:b]]) for a in range(len(text)) for b in range(a + 1, min(a + 16, len(text)) + 1) if text[a:b] in p]
        return len(text), found + [(a, a + 1, None, subword_lm.BYTE ** len(text[a].encode())) for a in range(len(text)) if text[a] not in p]

    def sums(word, p):
        size, found = edges(word, p)
        alpha = [1.0] + [0.0] * size
        for b in range(1, size + 1):
            alpha[b] = sum(alpha[s] * w for s, e, _, w in found if e == b)
        return size, found, alpha

    def refitted(c, p):
        total = {q: subword_lm.PRIOR * w for q, w in first.items()}
        for word in c:
            size, found, alpha = sums(word, p)
            beta = [0.0] * size + [1.0]
            for a in range(size - 1, -1, -1):
                beta[a] = sum(beta[e] * w for s, e, _, w in found if s == a)
            for s, e, piece, w in found:
                if piece is not None:
                    total[piece] += alpha[s] * w * beta[e] / alpha[size]
        whole = sum(total.values())
        return {q: w / whole for q, w in total.items()}

    def cut(c):
        once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once else 0.5
        return d, d * len(c)

    pieces = [first] * len(groups)
    for _ in range(rounds):
        pieces = [refitted(c, p) for c, p in zip(counts, pieces, strict=True)]
    (d, freed), own = cut(every), [cut(c) for c in counts]

    def p_word(w, k):
        size, _, alpha = sums(w, pieces[k])
        corpus = max(every[w] - d, 0) / n + freed / n * alpha[size]
        rest = (1 - subword_lm.CORPUS) * alpha[size] + subword_lm.CORPUS * corpus
        total = counts[k].total() + ends[k]
        return max(counts[k][w] - own[k][0], 0) / total + own[k][1] / total * rest if total else rest

    memo = {}
    for r in rows:
        words, parts = tokens(r[1])[:-1], []
        for k in groups:
            total = counts[k].total() + ends[k]
            p_end = ends[k] / total if ends[k] else 0.5 / (n + 1)
            seen, log = Counter(), math.log10((ends[k] + 0.5) / (n_ends + 0.5 * len(groups)))
            for i, w in enumerate(words):
                p = memo.setdefault((w, k), None) or memo.__setitem__((w, k), p_word(w, k)) or memo[w, k]
                repeat = seen[w] - subword_lm.DISCOUNT if seen[w] else 0.0
                log += math.log10((repeat + (subword_lm.STRENGTH + subword_lm.DISCOUNT * len(seen)) * p) / (i + subword_lm.STRENGTH))
                seen[w] += 1
            parts.append(log + math.log10((subword_lm.STRENGTH + subword_lm.DISCOUNT * len(seen)) * p_end / (len(words) + subword_lm.STRENGTH)))
        top = max(parts)
        yield top + math.log10(sum(10 ** (x - top) for x in parts))


def test_scores_against_a_plain_model(spark):
    rng = random.Random(2)
    syll = ["th", "ing", "ou", "er", "é", "eau", "😀", "a"]
    vocabulary = ["".join(rng.choice(syll) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))), rng.choice(["x", "y", None])) for i in range(24)] + [(None, "A th th", "x"), (30, None, "y")]
    rows[3] = (3, rows[3][1] + " unseenword unseenword", "x")
    tokens = lambda t: [*(t or "").encode().translate(subword_lm.LOWER).decode().split(), None]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    got = Counter((r.doc_id, round(r.score, 6)) for r in subword_lm.scores(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES).collect())
    want = Counter((r[0], round(s, 6)) for r, s in zip(rows, plain_scores(rows, subword_lm.ROUNDS, tokens, out), strict=True))
    assert got == want


def test_scores(docs, rows):
    got = subword_lm.scores(docs, PIECES).collect()
    tokens = lambda t: [*(t or "").encode().translate(subword_lm.LOWER).split(), None]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for r in rows if not out(r[0]) for w in tokens(r[1]))
    n, floor = c.total(), c.total() + 0.5 * (len(c) + 1)
    want = Counter()
    for r in rows:
        t = tokens(r[1])
        want[r[0], out(r[0]), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / floor) for w in t), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_pages(spark):
    shell = "<html><head><title>t</title></head><body><div>Site menu line</div><nav><a>x</a></nav>{}<p>Imprint</p><footer>f</footer></body></html>"
    bare = [shell.format(f"<div><p>Story {i} one &amp; two</p><p>Story  {i}\n three</p></div>") for i in range(4)]
    inside = "<article><h1>Head</h1><p>a<b>b</b> c</p><aside>no</aside><div class='comments'>no</div></article>"
    rows = [(i, f"http://h.org/p/{i}", h, "x") for i, h in enumerate(bare)]
    rows += [(10, "http://h.org/q/1", shell.format(inside), "x"), (11, "http://h.org/q/2", shell.format(inside), "x"), (12, None, None, "x"), (13, "odd", "", "x"), (14, "http://z.org/", "plain &lt; text", "x"), (14, "http://z.org/", "plain &lt; text", "x")]
    got = defaultdict(list)
    for r in page_text.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string").coalesce(1)).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[10] == got[11] == ["Head\nab c"] and got[12] == got[13] == [""] and got[14] == ["plain < text"] * 2
    for i in range(4):
        assert f"Story {i} one & two\nStory {i} three" in got[i][0]
    assert all(got[i] == [f"Story {i} one & two\nStory {i} three"] for i in range(4))


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(800):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        same, other = map(sorted, page_text.shared(a, b))
        assert [a[i] for i in same] == [b[j] for j in other]
        assert len(same) == best[-1][-1]
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in same))


def test_empty_tables(spark, empty):
    model = language_id.train(empty)
    assert language_id.predict(empty, model).count() == 0 and model.predict("text")[0] == "und"
    for df in (
        exact_dedup.exact_classes(empty), exact_dedup.exact_dedup(empty), simhash.components(empty), simhash.near_dedup(empty), mixing.mix(empty), mixing.mixture(empty), order_minhash.fingerprints(empty),
        token_counts.token_counts(empty, WORDS), token_store.round_trip(empty, BYTES), subword_lm.scores(empty, PIECES), piece_lattice.encode(empty, PIECES),
        page_text.page_texts(spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert df.collect() == []
