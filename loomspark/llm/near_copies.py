"""Near copies: documents whose word shingles have a Jaccard similarity of at least ``SIMILARITY``.

A document is the set of its runs of ``SHINGLE`` words (A-Z lower-cased, white
space collapsed), each an XXH64 hash. Equal sets are one class.

Candidates. Each set has a SimHash fingerprint, and ``simhash.links`` finds
what differs in ``MAX_BITS`` of its bits or fewer, by pigeonring chains as join
keys. What these links reach is a first group, and its members' whole sets are
compared. Two sets of the similarity differ in about 10 of 64 bits, some in 20,
a budget at which no chain selects anything. So what is left apart meets by
``BANDS`` keys of ``ROWS`` minimum hashes each (a pair of similarity s shares
none with probability (1 - s^ROWS)^BANDS: 5e-8 at 0.8, 9e-16 at 0.9), and what
these buckets hold in different groups by prefixes: shingles are ordered by how
many of these classes have them, and two sets of the similarity share one of
their first n - ceil(``SIMILARITY`` n) + 1 shingles, n being a set's size. A
passage that many unlike texts share is frequent, so it lies behind what each
text has alone, and pairs nothing; this is exact, whatever the keys.

Check. Candidates are links to a bucket's smallest, so they number as the
buckets' members and not as their pairs; star contraction joins them. All sets that they
reach meet in one place, where a search walks from set to set over those that
it hasn't reached yet: n copies cost about n comparisons, n unlike sets all of
their pairs, and neither makes rows of them. Groups over ``BLOCK`` shingles are
dealt out as all pairs of their blocks.

Defined results: texts without words are alike; a text of fewer words than a
shingle is one shingle; rows without identifier take no part and stay; rows
that share only the identifier are judged by their texts; an empty table gives
an empty result; other columns are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, slots, spread_lookup, stage, text_of
from .simhash import LOWER, SEED, contract, links, majority

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
#: Bits of the fingerprints that may differ at first.
MAX_BITS = 7
#: Shingles of a group that are held at once, twice over.
BLOCK = 1 << 18
#: Shingles hashed at a time.
SCAN = 4096
#: Pairs of texts in a worker's memory.
PAIRS = 128


def shingles(text: str | None, shingle: int = SHINGLE):
    """The sorted distinct hashes (uint64) of a text's shingles."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n))


def similarity(a, b) -> float:
    """The Jaccard similarity of two sorted sets; 1.0 if both are empty."""
    import numpy as np

    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both) if a.size or b.size else 1.0


def band_keys(own) -> list[int]:
    """The signed keys of a set's bands; none for the empty set."""
    import numpy as np
    import xxhash

    if not own.size:
        return []
    rng = np.random.Generator(np.random.PCG64(SEED))
    turn = rng.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
    times = rng.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for i in range(0, own.size, SCAN):
        least = np.minimum(least, ((own[None, i : i + SCAN] ^ turn) * times).min(axis=1))
    raw, width = least.tobytes(), 8 * ROWS
    keys = np.array([xxhash.xxh64_intdigest(raw[i * width : (i + 1) * width], i) for i in range(BANDS)], np.uint64)
    return keys.view(np.int64).tolist()


def sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, mark, text) -> (doc_id, mark, fp, n, bits, keys): fp is the set's hash, n its size, bits its SimHash fingerprint."""

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        for b in batches:
            fps, sizes, bits, keys = [], [], [], []
            for t in b.column(2):
                own = shingles(t.as_py(), shingle)
                fps.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                sizes.append(own.size)
                bits.append(majority((own[i : i + SCAN] for i in range(0, own.size + 1, SCAN)), own.size))
                keys.append(band_keys(own))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "mark", "fp", "n", "bits", "keys"])

    return rows.mapInArrow(scan, "doc_id long, mark long, fp long, n long, bits long, keys array<long>")


def by_bits(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a > b: links whose components are those of all classes (fp, bits) that differ in so many bits or fewer."""
    n = slots(classes.sparkSession)
    least = stage(classes.groupBy("bits").agg(F.min("fp").alias("least")), "fingerprints")
    same = spread_lookup(classes.select("fp", "bits"), least, "bits", "fp", n).where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    # one segment more makes buckets 16 times smaller; the result doesn't depend on it
    near = links(least.select(F.col("bits").alias("fp")), chain=3 if least.count() < 1 << 24 else 4, max_bits=max_bits)
    a = least.select(F.col("bits").alias("a"), F.col("least").alias("x"))
    b = least.select(F.col("bits").alias("b"), F.col("least").alias("y"))
    far = spread_lookup(near.join(a, "a"), b, "b", "a", n)
    return same.unionByName(far.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")))


def joined(roots: list[int], own: list, least: float) -> list[tuple[int, int]]:
    """Links (root, least root that it reaches) of sets, none of them empty, of which those of one root are joined already."""
    import numpy as np

    order = sorted(range(len(own)), key=lambda i: own[i].size)
    root, size = np.array([roots[i] for i in order], np.int64), np.array([own[i].size for i in order], np.int64)
    ids = np.unique(np.concatenate([own[i] for i in order]), return_inverse=True)[1]
    mark, found = np.zeros(ids.size, bool), []
    while root.size:
        reached, now, todo = [], {int(root[0])}, []
        while now or todo:
            if now:
                new = np.isin(root, list(now))
                spread = np.repeat(new, size)
                todo += np.split(ids[spread], np.cumsum(size[new])[:-1])
                root, size, ids = root[~new], size[~new], ids[~spread]
                reached += now
            if not root.size:
                break
            one, now = todo.pop(), set()
            fit = np.flatnonzero(np.minimum(size, one.size) / np.maximum(size, one.size) >= least)
            if fit.size:
                lo, hi = fit[0], fit[-1] + 1  # sizes ascend
                at = np.concatenate(([0], np.cumsum(size[:hi])))[lo:]
                mark[one] = True
                both = np.add.reduceat(mark[ids[at[0] : at[-1]]], at[:-1] - at[0], dtype=np.int64)
                mark[one] = False
                now = set(root[lo:hi][both / (one.size + size[lo:hi] - both) >= least].tolist())
        found += [(r, min(reached)) for r in reached if r > min(reached)]
    return found


def checked(candidates: DataFrame, groups: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b): the roots a whose sets are linked to those of smaller roots, and the smallest such root.

    ``candidates``: links (a, b) of roots, a > b; ``groups``: (fp, n, root), the sets to compare. All sets of roots that
    candidates reach are compared with each other, but for those that are joined already.
    """

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for _, group in itertools.groupby(rows, key=itemgetter(0)):
            roots, own = [], []
            for _, root, text in group:
                roots.append(root)
                own.append(shingles(text, shingle))
            if near := joined(roots, own, least):
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in near], pa.int64()) for k in (0, 1)], names=["a", "b"])

    n = slots(groups.sparkSession)
    reach = contract(candidates)
    reach = reach.unionByName(reach.select(F.col("b").alias("a"), "b").distinct()).select(F.col("a").alias("root"), F.col("b").alias("comp"))
    members = stage(spread_lookup(groups, reach, "root", "fp", n), "reached")
    held = members.groupBy("comp").agg(F.sum("n").alias("held"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    blocks = stage(held.select("comp", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("fp", F.lit(5)), F.col("blocks"))
    dealt = spread_lookup(members, blocks, "comp", "fp", n).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # a block's own pairs are compared beside any other block
    dealt = dealt.where("blocks = 1 or own <> other").select("fp", "root", F.xxhash64("comp", F.least("own", "other"), F.greatest("own", "other")).alias("pair"))
    met = dealt.join(texts, "fp").select("pair", "root", "text").repartition(n, "pair").sortWithinPartitions("pair")
    found = stage(met.mapInArrow(scan, "a long, b long"), "linked")
    return found if blocks.where("blocks > 1").isEmpty() else contract(found.distinct())


def prefixes(groups: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(token, fp, n, root, least_root): the shingles of the classes' prefixes that different groups have.

    ``groups``: (fp, n, root), a row a class; every pair of different groups that is similar shares a token.
    """

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in (batch.slice(i, PAIRS) for batch in batches for i in range(0, batch.num_rows, PAIRS)):
            for fp, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = shingles(text, shingle)
                for i in range(0, own.size, SCAN):
                    part = own[i : i + SCAN].view("int64")
                    yield pa.RecordBatch.from_arrays([pa.array([fp] * part.size, pa.int64()), pa.array(part)], names=["fp", "token"])

    found = groups.select("fp").join(texts, "fp").select("fp", "text").mapInArrow(scan, "fp long, token long")
    found = stage(found, "open-shingles")
    counts = found.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    # shingles of one class alone come first and pair nothing: they only use up the prefix
    common = spread_lookup(found, counts, "token", "fp", slots(groups.sparkSession))
    placed = Window.partitionBy("fp").orderBy("held", "token")
    ranked = common.select("*", F.row_number().over(placed).alias("place"), F.count("*").over(Window.partitionBy("fp")).alias("shared"))
    sized = ranked.join(groups, "fp").withColumn("prefix", F.col("n") - F.ceil(F.round(F.lit(least) * F.col("n"), 6)) + 1)
    first = sized.where("place + n - shared <= prefix").select("token", "fp", "n", "root")
    mixed = first.groupBy("token").agg(F.min("root").alias("least_root"), F.max("root").alias("hi")).where("least_root <> hi").drop("hi")
    return stage(first.join(mixed, "token"), "prefixes")


def by_prefixes(groups: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b), a > b: all pairs of different groups that share a token of ``prefixes`` and whose sizes allow the similarity.

    They number as the square of a group; the stage links each class to a token's least group instead.
    """
    first = prefixes(groups, texts, shingle, least)
    other = first.select("token", F.col("fp").alias("b"), F.col("n").alias("b_n"), F.col("root").alias("b_root"))
    near = first.join(other, "token").where((F.col("fp") > F.col("b")) & (F.col("root") != F.col("b_root")) & (F.least("n", "b_n") / F.greatest("n", "b_n") >= F.lit(least)))
    return near.select(F.col("fp").alias("a"), "b").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all columns, whose identifier is the smallest of its group; rows without identifier stay."""
    n = slots(docs.sparkSession)
    mark = F.xxhash64(text_of(text_col))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), mark.alias("mark"), text_of(text_col).alias("text"))
    members = stage(sets(rows, shingle), "shingle-sets")
    classes = members.groupBy("fp").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("keys").alias("keys"))
    classes = stage(classes.select("fp", "first.doc_id", "first.mark", "n", "bits", "keys"), "classes")
    near = stage(by_bits(classes.where("n > 0")), "links")
    keyed = classes.select("fp", "n", F.explode("keys").alias("key")).repartition(n, "key")
    full = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    buckets = stage(keyed.join(full, "key"), "buckets")
    wanted = buckets.select("fp").union(near.select("a")).union(near.select("b")).distinct()
    wanted = stage(wanted.join(classes, "fp").select("fp", "doc_id", "mark"), "wanted")
    texts = stage(rows.join(wanted, ["doc_id", "mark"]).select("fp", "text").dropDuplicates(["fp"]), "near-texts")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = docs.sparkSession.conf.get(batch)
    try:
        # a row of a check holds a whole text; all of these steps run here
        docs.sparkSession.conf.set(batch, str(PAIRS))
        roots = checked(near, classes.select("fp", "n", F.col("fp").alias("root")), texts, shingle, least).withColumnRenamed("a", "fp")
        rooted = stage(buckets.join(roots, "fp", "left").select("key", "fp", "n", F.coalesce("b", "fp").alias("root")), "rooted")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        open_ = stage(rooted.join(mixed, "key").groupBy("fp").agg(F.first("n").alias("n"), F.first("root").alias("root")), "open-classes")
        first = prefixes(open_, texts, shingle, least)
        stars = first.where("root <> least_root").select(F.col("root").alias("a"), F.col("least_root").alias("b")).distinct()
        further = checked(stars, first.select("fp", "n", "root").distinct(), texts, shingle, least)
    finally:
        docs.sparkSession.conf.set(batch, before)
    found = classes.select("fp", "doc_id").join(roots, "fp", "left").select("fp", "doc_id", F.coalesce("b", "fp").alias("root"))
    further = further.select(F.col("a").alias("root"), F.col("b").alias("least"))
    found = spread_lookup(found, found.select("root").distinct().join(further, "root", "left"), "root", "fp", n).select("fp", "doc_id", F.coalesce("least", "root").alias("root"))
    groups = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    best = found.join(groups, "root").select("fp", "component_id")
    lost = spread_lookup(members.select("doc_id", "mark", "fp"), best, "fp", "doc_id", n).where("doc_id <> component_id")
    lost = stage(lost.select(F.col("doc_id").alias(OWN + "id"), F.col("mark").alias(OWN + "mark")).distinct(), "near-copies")
    return docs.join(lost, (F.col(id_col).cast("long") == F.col(OWN + "id")) & (mark == F.col(OWN + "mark")), "left_anti")
