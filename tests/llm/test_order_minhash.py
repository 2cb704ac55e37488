"""Order MinHash on texts that repeat passages: occurrences count."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from loomspark.llm import order_minhash


PLACE = (1 << 30) - 1


def plain_signature(text):
    """As the module says: a k-mer's first occurrence is ordered by its own hash, the others by one of (k-mer, number)."""
    words = [u for w in (text or "").split() for u in (w if len(w) > order_minhash.WORD else [w])]
    words = [w.encode() for w in words]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    of_long = lambda v, seed=42: xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
    of_int = lambda v, seed: xxhash.xxh64_intdigest(v.to_bytes(4, "little"), seed)
    h = [xxhash.xxh64_intdigest(w, 42) for w in words]
    kmers = [signed(of_long(b, of_long(a))) for a, b in zip(h, h[1:], strict=False)]
    if len(h) == 1:
        kmers = [signed(xxhash.xxh64_intdigest(str(signed(h[0])).encode(), 42))]
    seen, packed = Counter(), []
    for i, k in enumerate(k & ~PLACE for k in kmers):
        n = seen[k]
        packed.append((k if n == 0 else signed(of_int(n, of_long(k))) & ~PLACE) | i)
        seen[k] += 1
    packed.sort()
    out = []
    for b in range(-32, 32):
        own = [p & PLACE for p in packed if p >> 58 == b][:2]
        seed = 42
        for at in sorted(own):
            seed = of_long(kmers[at], seed)
        out.append(signed(seed) % (1 << 16) if own else None)
    return out


def test_repeats_count(spark):
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(5000)}" for _ in range(400))
    texts = {n: " ".join([passage] * n) for n in (1, 2, 3, 20, 100)} | {0: "a a a a a a b a a", 7: "a b " * 300}
    df = spark.createDataFrame(list(texts.items()), "n int, text string")
    got = {r.n: r.sig for r in df.select("n", order_minhash.signature(F.col("text")).alias("sig")).collect()}
    for n, t in texts.items():
        assert got[n] == plain_signature(t)
    like = lambda a, b: sum(x == y for x, y in zip(got[a], got[b], strict=True)) / 64
    assert 0.2 < like(2, 3) < 0.8 and like(2, 20) < 0.2 and like(2, 100) < 0.2 and like(3, 100) < 0.2


def plain_likeness(a, b):
    both = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(x == y for x, y in both) / len(both) if both else 1.0


def check(spark, rows, got):
    """Every row's fingerprint, edited text and likenesses, from the rows in the order of the contract."""
    texts = [(d, t or "") for d, t in rows]
    by_hash = {t: spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).first()[0] for _, t in texts} if len({d for d, _ in rows}) < len(rows) else {}
    texts.sort(key=lambda r: (r[0] is None, -(r[0] or 0), by_hash.get(r[1], 0)))
    want = Counter()
    for i, (d, t) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        third = len(t) // 3
        edit = t[: len(t) - third] + following[:third]
        a, b, c = map(plain_signature, (t, edit, following))
        printed = "".join("----" if v is None else f"{v:04x}" for v in a)
        want[d, len(t), hashlib.sha256(edit.encode()).hexdigest(), printed, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want


def some_text(rng):
    return " ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice((0, 1, 2, 9, 60))))


@pytest.mark.parametrize("kind", ["dense", "sparse", "clustered", "null and repeated", "one", "all null"])
def test_next_documents(spark, monkeypatch, kind):
    monkeypatch.setattr(order_minhash, "CELL", 4)
    rng = random.Random(5)
    ids = {
        "dense": list(range(60)),
        "sparse": [rng.randrange(-(1 << 63), 1 << 63) for _ in range(60)],
        "clustered": [*range(50), *[(1 << 62) + i for i in range(5)], -(1 << 63), (1 << 63) - 1],
        "null and repeated": [*range(20), *[None] * 20, *[7] * 20],
        "one": [3],
        "all null": [None] * 30,
    }[kind]
    rows = [(d, some_text(rng) if rng.random() < 0.9 else None) for d in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(spark, rows, order_minhash.fingerprints(df).collect())


def test_repeats_tell_texts_apart(spark):
    df = spark.createDataFrame([(2, "a " * 4000), (1, "a " * 4)], "doc_id long, text string")
    assert {r.near_next for r in order_minhash.fingerprints(df).collect()} != {1.0}


@pytest.mark.parametrize("kind", ["clustered", "repeated", "dense"])
def test_no_cell_is_large(spark, kind):
    """Identifiers close together with one far off, or one on most rows, leave no cell beyond four times the usual."""
    n = 20000
    ident = {"clustered": F.when(F.col("id") == 0, F.lit(9 * 10**18)).otherwise(F.col("id")), "repeated": F.when(F.col("id") % 10 < 7, 5).otherwise(F.col("id")), "dense": F.col("id")}[kind]
    docs = spark.range(n).select(ident.cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    cells = docs.select(order_minhash.cell_of(docs, F.col("doc_id"), F.col("text")).alias("cell")).groupBy("cell").count()
    assert cells.agg(F.max("count")).first()[0] <= 4 * order_minhash.CELL
    # cells follow the order: greater identifiers, then smaller hashes, have greater cells
    rows = docs.select(order_minhash.cell_of(docs, F.col("doc_id"), F.col("text")).alias("cell"), "doc_id", F.xxhash64("text").alias("h")).collect()
    own = [r.cell for r in sorted(rows, key=lambda r: (-r.doc_id, r.h))]
    assert own == sorted(own, reverse=True)


def test_texts_without_spaces(spark):
    rng = random.Random(11)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x4E00 + 800)) for _ in range(400))
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(500))
    pairs = {"less one": (chinese, chinese[:200] + chinese[201:]), "one edit": (letters, letters[:250] + "#" + letters[251:]), "other": (letters, letters[::-1]), "emoji": ("\U0001f600" * 30 + "x", "\U0001f600" * 30 + "x")}
    df = spark.createDataFrame([(k, *v) for k, v in pairs.items()], "k string, a string, b string").select("k", order_minhash.signature(F.col("a")).alias("a"), order_minhash.signature(F.col("b")).alias("b"))
    got = {r.k: r for r in df.collect()}
    like = {k: plain_likeness(r.a, r.b) for k, r in got.items()}
    assert like["less one"] > 0.7 and like["one edit"] > 0.7 and like["other"] < 0.3 and like["emoji"] == 1.0
    for k, (a, b) in pairs.items():
        assert got[k].a == plain_signature(a) and got[k].b == plain_signature(b)
