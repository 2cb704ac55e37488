"""SimHash near-deduplication with pigeonring filtering.

A document's fingerprint takes, for each of 64 bits, the majority of the XXH64
hashes of its word shingles. Equal fingerprints are one class; classes link
when they differ in ``MAX_BITS`` bits or fewer, and a component is what links
reach. ``links`` takes other budgets; the figures below are those of four bits.

Candidates. The 64 bits form a ring of a segment more than the budget has bits,
so five segments, each of which has 4/5 of a bit. By the pigeonring principle a pair
within budget has a segment from which every chain of l consecutive segments
differs in at most l * 4/5 bits: the first segment not at all, the first two
together in one bit, three in two, four in three. A chain of l segments is
turned into equality keys: the first segment, and a choice of half segments
among the others that must be free of differences, as many as its bits leave
untouched. Pairs that share a key then have the whole ring checked. ``chain`` grows with the
logarithm of the number of classes (19, 26 or 32 key bits), so that chance
meetings stay in proportion to the input; results do not depend on it.

Groups. Copies are a class before any pairing. In a bucket, a search walks
from member to member over those not yet reached, so a dense group of n near
copies costs about n comparisons and yields n - 1 links, not n^2. Buckets over
``BLOCK`` members are dealt out as all pairs of their blocks, an exact way to
bound a task. Links are joined by star contraction, each round written to the
shared folder.

Defined results: null and word-less texts have fingerprint zero and link like
any other; a text of fewer words than a shingle is one shingle; rows with a
null identifier get the component of their fingerprint; repeated rows repeat;
other columns are ignored by ``components``; an empty table gives an empty
result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import OWN, slots, spread_lookup, stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 8192
#: Members up to which a bucket's pairs are compared before anything walks it.
SMALL = 32
#: Python's bytes.translate table that lower-cases A-Z alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SCAN = 1 << 16


def majority(blocks: Iterator, n: int) -> int:
    """The 64 bits that over half of ``n`` hashes have, which come in arrays of uint64; an empty one ends them."""
    import numpy as np

    counts = np.zeros(64, np.int64)
    for block in itertools.takewhile(len, blocks):
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    import numpy as np
    import xxhash

    # bytes.split() without arguments splits at runs of \x20 and \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest, cuts = xxhash.xxh64_intdigest, zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    return majority((np.array([digest(joined[a:b], SEED) for a, b in itertools.islice(cuts, SCAN)], np.uint64) for _ in itertools.count()), n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "doc_id long, fp long")


@lru_cache
def segments(max_bits: int) -> tuple[tuple[int, int], ...]:
    """First bit and width of each segment, from the lowest bit: one more than bits may differ."""
    m = max_bits + 1
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return tuple((sum(widths[:i]), w) for i, w in enumerate(widths))


def chain_keys(chain: int, max_bits: int = MAX_BITS) -> list:
    """Columns of the equality keys of a chain: exact first segment, then all choices of untouched halves."""
    keys, parts = [], segments(max_bits)
    for i in range(len(parts)):
        ring = [parts[(i + d) % len(parts)] for d in range(chain)]
        halves = [h for at, width in ring[1:] for h in ((at, width // 2), (at + width // 2, width - width // 2))]
        # chain - 1 bits may differ in 2 * (chain - 1) halves
        for free in itertools.combinations(halves, chain - 1):
            mask = 0
            for at, width in (ring[0], *free):
                mask |= ((1 << width) - 1) << at
            signed = mask - (1 << 64) if mask >= 1 << 63 else mask
            # the mask's number keeps keys of different masks apart
            keys.append(F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed)), F.lit(len(keys))))
    return keys


def _pass(x, max_bits: int = MAX_BITS):
    """Which differences (uint64 array) keep the budget.

    A chain over the whole ring keeps its share at every length, from some segment, exactly if all 64 bits keep the
    budget (the cycle lemma), so one count of bits checks both.
    """
    import numpy as np

    return np.bitwise_count(x) <= max_bits


def walk(fps, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links (member, smallest member of its group) within one bucket of distinct uint64 fingerprints."""
    import numpy as np

    left, links = np.sort(fps.view(np.int64)), []
    while left.size > 1:
        root, left = left[0], left[1:]
        group, todo = [], [root]
        while todo and left.size:
            near = _pass(left.view(np.uint64) ^ np.int64(todo.pop()).view(np.uint64), max_bits)
            if near.any():
                found = left[near].tolist()
                group += found
                todo += [np.int64(f) for f in found]
                left = left[~near]
        links += [(f, int(root)) for f in group]
    return links


def _links(batches: Iterator, max_bits: int = MAX_BITS) -> Iterator:
    """Rows sorted by (key, fp) -> links. A bucket may span batches; only one bucket is held at a time."""
    import numpy as np
    import pyarrow as pa

    def out(links: list) -> pa.RecordBatch:
        a = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            key, fp, upto = held_key, held, held.size
        else:
            key = np.concatenate((held_key, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((held, batch.column(1).to_numpy(zero_copy_only=False)))
            upto = int(np.searchsorted(key == key[-1], True)) if key.size else 0
        held_key, held = key[upto:], fp[upto:]
        key, fp = key[:upto], fp[:upto]
        if not upto:
            continue
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, upto))
        two = starts[sizes == 2]
        near = two[_pass(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64), max_bits)] if two.size else two
        links = [np.stack((np.maximum(fp[near], fp[near + 1]), np.minimum(fp[near], fp[near + 1])), 1)]
        # most small buckets hold no near pair, which is seen for all of them at once
        wanted = sizes > SMALL
        bucket = np.repeat(np.arange(sizes.size), np.where((sizes > 2) & ~wanted, sizes, 0))
        small = fp[np.repeat((sizes > 2) & ~wanted, sizes)]
        for d in range(1, int(sizes[~wanted].max(initial=1))):
            met = np.flatnonzero(bucket[:-d] == bucket[d:])
            met = met[_pass(small[met].view(np.uint64) ^ small[met + d].view(np.uint64), max_bits)]
            wanted[bucket[met]] = True
        for at, n in zip(starts[wanted].tolist(), sizes[wanted].tolist(), strict=True):
            if own := walk(np.unique(fp[at : at + n]).view(np.uint64), max_bits):
                links.append(np.array(own, np.int64))
        links = np.concatenate(links)
        if links.size:
            yield out(links)


def links(classes: DataFrame, chain: int | None = None, block: int = BLOCK, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct links (a, b), a > b, whose components are those of all pairs within ``max_bits`` of ``classes`` (fp)."""
    n = slots(classes.sparkSession)
    if chain is None:
        count = classes.count()
        chain = 2 if count < 1 << 24 else 3 if count < 1 << 31 else 4
    keyed = classes.select("fp", F.explode(F.array(*chain_keys(chain, max_bits))).alias("key"))
    full = keyed.groupBy("key").count().where(F.col("count") > block).select(F.col("key").alias("hot"), F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    full = stage(full, "full-buckets")
    if not full.isEmpty():
        met = keyed.join(full, F.col("key") == F.col("hot"), "left")
        own = F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks"))
        dealt = met.withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
        pair = F.xxhash64("key", F.least(own, F.col("other")), F.greatest(own, F.col("other")))
        keyed = dealt.select("fp", F.when(F.col("blocks").isNull(), F.col("key")).otherwise(pair).alias("key"))
    dealt = keyed.select("key", "fp").repartition(n, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(lambda batches: _links(batches, max_bits), "a long, b long").distinct()


def contract(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Links (a, b), a > b -> (a, b): b is the smallest node that a reaches. Nodes without links are absent.

    Large-star and small-star steps in turn, until a round changes nothing;
    what a round wrote is counted as it is written.
    """
    said = None
    edges = stage(edges, "links")
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # dealt once for what follows: a node has no more rows than it has smaller neighbours
        large = large.repartition("a").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        seen = Observation()
        after = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = stage(after.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "links")
        now = seen.get
        if now == said:
            return edges
        said = now
    raise RuntimeError("links did not contract")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id reachable."""
    members = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(members.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = contract(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "first", F.coalesce("b", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    n = slots(docs.sparkSession)
    return spread_lookup(members, found, "fp", "doc_id", n).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all columns, whose identifier is the smallest of its component; rows without identifier stay."""
    keep = components(docs, id_col, text_col, shingle).where("doc_id = component_id").select(F.col("doc_id").alias(OWN + "keep")).distinct()
    met = docs.join(keep, F.col(id_col).cast("long") == F.col(OWN + "keep"), "left")
    return met.where(F.col(OWN + "keep").isNotNull() | F.col(id_col).isNull()).select(*docs.columns)
