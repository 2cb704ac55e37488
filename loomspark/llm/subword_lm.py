"""Language-model scores: subword lattice likelihood.

The model of a token. An existing vocabulary's pieces span the lattice of a
word's segmentations; a segmentation weighs the product of its pieces'
probabilities, and the forward recursion in log space sums over all of them:
that is the word's marginal probability. The vocabulary's own scores are the
first piece probabilities and stay in them as ``PRIOR`` pseudo-counts; as this
lattice speaks for words not seen before, ``ROUNDS`` rounds of expectation
maximisation over the distinct training words fit them to the corpus. A word
seen in training also has an edge of its own that spans the whole lattice,
weighing its count less a discount D = n1 / (n1 + 2 n2) (n1, n2: words that
occur once, twice); what the discounts free is the lattice's share. The end of
a text is a token with its share.

A document's score is the sum over groups of training documents (by language)
of the group's share times the document's probability under the group. Inside
a document, tokens come from a Pitman-Yor cache over these probabilities: a
word that occurred k times among i words, t of them distinct, weighs
(k - DISCOUNT + (STRENGTH + DISCOUNT t) p) / (i + STRENGTH).

Counts are gathered from every training document: blocks of text give their
distinct words with counts (see ``blocks``), which are summed by word. Word
probabilities go back to the blocks in the same way, and each block scores its
own documents. Piece statistics, a row a piece, are all that reaches the driver.

Defined results: a null text is empty and has the end token alone; without
training documents N is 0, every word has its lattice probability and the end
0.5; a character without a piece weighs ``BYTE`` for each UTF-8 byte; rows
with a null identifier belong to training; groups of less than ``LEAST_SHARE``
of the training documents share one; repeated rows count each time; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import numbers_of, scan_blocks
from .common import bucketed, compressor, decompressor, slots, stage_kinds, text_of
from .piece_lattice import MARK, pieces

ROUNDS = 2
#: Share of a group's unseen mass that goes to words of the corpus as a whole.
CORPUS = 0.1
#: A group of training documents has a model of its own from this share of them on.
LEAST_SHARE = 0.005
#: The cache of a document.
STRENGTH, DISCOUNT = 200.0, 0.9
#: Probability of a byte of a character without a piece.
BYTE = 1e-4 / 256
#: Added to a piece's expected count, in proportion to its first probability.
PRIOR = 100.0
#: Words of a document scored at a time.
SLICE = 1 << 18
#: Table for bytes.translate that lower-cases A-Z alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str) -> list[str]:
    """bytes.split() splits at runs of \\x20 and \\x09-\\x0D."""
    found = b" ".join(text.encode("utf-8", "surrogatepass").translate(LOWER).split())
    return found.decode("utf-8", "surrogatepass").split(" ") if found else []


def held_out(ident: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


class PieceTable:
    """Finds pieces and their beginnings by a 64-bit polynomial hash of their characters, for whole arrays of substrings at once.

    The first of ``WAYS`` entries of a slot answers nearly always; the
    multiplier of the slot number is changed until every key fits. Piece
    numbers start from 1; 0 is a beginning that is no piece itself, -1 is neither.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    WAYS, LOG2 = 4, 20

    def __init__(self, names: list[str]):
        self.size, self.longest = len(names), max(map(len, names))
        number = {p: i for i, p in enumerate(names, 1)}
        starts = list({p[:k] for p in names for k in range(1, len(p) + 1)})
        hashes, values = np.array([self.of(p) for p in starts], np.uint64), np.array([number.get(p, 0) for p in starts], np.int32)
        for seed in range(1, 1000):
            self.spread = np.uint64(0xD1B54A32D192ED03 + 2 * seed)
            slots = ((hashes * self.spread) >> np.uint64(64 - self.LOG2)).astype(np.int64)
            order = np.argsort(slots, kind="stable")
            place = np.arange(len(starts)) - np.searchsorted(slots[order], slots[order])
            if place.max(initial=0) < self.WAYS:
                break
        else:
            raise ValueError("the pieces don't fit their table")
        self.keys = np.zeros((self.WAYS, 1 << self.LOG2), np.uint64)
        self.numbers = np.full((self.WAYS, 1 << self.LOG2), -1, np.int32)
        self.keys[place, slots[order]] = hashes[order]
        self.numbers[place, slots[order]] = values[order]
        self.more = self.numbers[1] >= 0

    @classmethod
    def of(cls, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(cls.BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slots = ((hashes * self.spread) >> np.uint64(64 - self.LOG2)).astype(np.int64)
        out = np.where(self.keys[0][slots] == hashes, self.numbers[0][slots], -1)
        rest = np.flatnonzero((out < 0) & self.more[slots])
        for keys, numbers in zip(self.keys[1:], self.numbers[1:], strict=True):
            out[rest] = np.where(keys[slots[rest]] == hashes[rest], numbers[slots[rest]], out[rest])
        return out


@lru_cache(4)
def vocabulary_index(path: str) -> PieceTable:
    return PieceTable([p for p, *_ in pieces(path)[0]])


def first_weights(path: str) -> np.ndarray:
    """Probabilities by piece number, from the vocabulary's scores.

    Scores of a unigram vocabulary are log probabilities. Those of a BPE
    vocabulary are negative ranks, which stand for 1 / (rank + 2).
    """
    scores = np.array([s for *_, s in pieces(path)[0]])
    ranks = scores.size > 1 and np.all(scores <= 0) and np.all(scores == np.round(scores))
    weights = 1 / (2.0 + np.minimum(-scores, len(scores))) if ranks else np.exp(scores - scores.max())
    return np.concatenate(([0.0], weights / weights.sum()))


def lattices(found: list[str], index: PieceTable) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Groups of words of one length: (places in ``found``, piece numbers [word, end, length - 1], weights of bare characters [word, end])."""
    by_length = defaultdict(list)
    for i, w in enumerate(found):
        by_length[len(w) + 1].append(i)
    for n, places in by_length.items():
        longest = min(index.longest, n)
        step = max(1, (1 << 20) // (n * longest))
        for at in range(0, len(places), step):
            part = places[at : at + step]
            text = "".join([MARK + found[i] for i in part])
            chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
            # only starts that some piece goes on from are followed further
            place, hashes = np.arange(chars.size), np.zeros(chars.size, np.uint64)
            ids = np.zeros((len(part), n + 1, longest), np.int32)
            bare = np.zeros((len(part), n + 1))
            for k in range(longest):
                if k:
                    on = np.flatnonzero((number >= 0) & (place % n + k < n))  # noqa: F821
                    place, hashes = place[on], hashes[on]
                hashes = hashes * PieceTable.BASE + chars[place + k]
                number = index.find(hashes)
                hit = np.flatnonzero(number > 0)
                ids[place[hit] // n, place[hit] % n + k + 1, k] = number[hit]
                if not k:
                    for p in np.flatnonzero(number <= 0).tolist():
                        bare[p // n, p % n + 1] = BYTE ** len(text[p].encode("utf-8", "surrogatepass"))
            yield part, ids, bare


def forward(ids: np.ndarray, bare: np.ndarray, weights: np.ndarray, ways: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(natural log of the sum over all segmentations, by word; with ``ways`` the share of each edge among those that end with it).

    The log of each prefix's sum is kept; ``before`` holds the sums of the
    prefixes before it in proportion to the last one's.
    """
    m, ends, longest = ids.shape
    logs, before = np.zeros(m), np.zeros((m, longest))
    before[:, 0] = 1.0
    shares = np.zeros(ids.shape) if ways else None
    for b in range(1, ends):
        x = before * weights[ids[:, b]]
        x[:, 0] += before[:, 0] * bare[:, b]
        t = x.sum(axis=1)
        logs += np.log(t)
        if ways:
            shares[:, b] = x / t[:, None]
        # a prefix so far behind in mass is one that no piece reaches over
        before[:, 1:] = np.minimum(before[:, :-1] / t[:, None], 1e300)
        before[:, 0] = 1.0
    return logs, shares


def expected(ids: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Probability of each edge over the segmentations of its word: that a piece ends there, times the edge's share."""
    m, ends, longest = ids.shape
    meets, out = np.zeros((m, ends)), np.zeros(ids.shape)
    meets[:, -1] = 1.0
    for b in range(ends - 1, 0, -1):
        k = min(longest, b)
        out[:, b, :k] = meets[:, b, None] * shares[:, b, :k]
        meets[:, b - k : b] += out[:, b, :k][:, ::-1]
    return out


def refit(counted: DataFrame, path: str, weights: np.ndarray) -> np.ndarray:
    """One round: expected counts of the pieces over each group's distinct words -> new probabilities, [group, piece]."""
    sent = counted.sparkSession.sparkContext.broadcast(weights)  # a number a piece and group
    groups = len(weights)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, index = np.zeros(sent.value.shape), vocabulary_index(path)
        alike = all(np.array_equal(sent.value[0], w) for w in sent.value)
        for b in batches:
            found = b.column(0).to_pylist()
            has = np.array([b.column(1 + k).to_numpy(zero_copy_only=False) > 0 for k in range(groups)])
            for part, ids, bare in lattices(found, index):
                edges = expected(ids, forward(ids, bare, sent.value[0], True)[1]) if alike else None
                for k in range(groups):
                    at = np.flatnonzero(has[k, part])
                    if at.size:
                        own = ids[at]
                        share = edges[at] if alike else expected(own, forward(own, bare[at], sent.value[k], True)[1])
                        total[k] += np.bincount(own.ravel(), share.ravel(), total.shape[1])
        total[:, 0] = 0.0
        k, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[k, at])], names=["k", "piece", "share"])

    sums = counted.mapInArrow(scan, "k int, piece int, share double").groupBy("k", "piece").agg(F.sum("share").alias("share")).collect()
    out = PRIOR * np.tile(first_weights(path), (groups, 1))
    for r in sums:
        out[r["k"], r["piece"]] += r["share"]
    return out / out.sum(axis=1, keepdims=True)


def group_marks(docs: DataFrame, id_col: str, group_col: str | None) -> tuple[Column, int]:
    """(each row's group as a number from 0, -1 for held-out rows; the number of groups). The rarer groups share the last."""
    group = F.lit("") if group_col is None or group_col not in docs.columns else F.coalesce(F.col(group_col).cast("string"), F.lit(""))
    sizes = docs.where(~held_out(id_col)).groupBy(group.alias("g")).count()
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    names = [r["g"] for r in sizes.where(F.col("count") >= LEAST_SHARE * total).orderBy(F.desc("count"), "g").collect()]  # 1 / LEAST_SHARE rows at most
    mark = F.coalesce(*[F.when(group == g, i) for i, g in enumerate(names)], F.lit(len(names)))
    return F.when(held_out(id_col), -1).otherwise(mark).cast("int"), len(names) + 1


def cached(at: np.ndarray, p: np.ndarray, seen: np.ndarray, distinct: np.ndarray, i: np.ndarray) -> np.ndarray:
    """log10 of each word's probability, [word, group], given what of the document stands before it."""
    repeat = np.where(seen > 0, seen - DISCOUNT, 0.0)
    return np.log10((repeat[:, None] + (STRENGTH + DISCOUNT * distinct)[:, None] * p[at]) / (i + STRENGTH)[:, None])


def history(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a document: how often it occurred before, and how many distinct words did."""
    order = np.argsort(at, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1]))) if len(at) else np.zeros(0, np.int64)
    seen = np.empty(len(at), np.int64)
    seen[order] = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return seen, np.concatenate(([0], np.cumsum(seen == 0)))


def scores(docs: DataFrame, path: str, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, slot_count = docs.sparkSession, slots(docs.sparkSession)
    mark, groups = group_marks(docs, id_col, group_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), mark.alias("mark"))
    of_group = [f"n{k}" for k in range(groups)]
    both = stage_kinds(scan_blocks(rows, words, "both", groups), "words")
    units = bucketed(both.where("kind = 'units'").select("block", "local", "unit", *of_group), "unit", slot_count, "words")
    counted = bucketed(units.groupBy("unit").agg(*[F.sum(c).alias(c) for c in of_group]), "unit", slot_count, "counts", dealt=True)
    every = sum(F.col(c) for c in of_group)
    of_all = {"": every} | {f"_{c}": F.col(c) for c in of_group}
    known = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum{n}") for n, c in of_all.items()], *[F.count_if(c > 0).alias(f"some{n}") for n, c in of_all.items()], *[F.count_if(c == k).alias(f"in{k}{n}") for k in (1, 2) for n, c in of_all.items()]).first()
    ends = np.zeros(groups)
    for r in both.where("kind = 'streams' and mark >= 0").groupBy("mark").count().collect():
        ends[r["mark"]] = r["count"]
    n_ends = int(ends.sum())
    n, v = known["sum"] + n_ends, known["some"] + (n_ends > 0)

    def discounted(name: str) -> tuple[float, float]:
        """(the discount of a word's count, all that the discounts free)."""
        once, twice = known[f"in1{name}"], known[f"in2{name}"]
        d = once / (once + 2 * twice) if once else 0.5
        return d, d * known[f"some{name}"]

    sizes = np.array([known[f"sum_{c}"] for c in of_group]) + ends
    weights = np.tile(first_weights(path), (groups, 1))
    if n:
        for _ in range(rounds):
            weights = refit(counted, path, weights)
    sent = spark.sparkContext.broadcast(weights)  # a number a piece and group
    of_log = [f"l{k}" for k in range(groups)]
    cuts, (cut, free) = [discounted(f"_{c}") for c in of_group], discounted("")

    def score_words(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = vocabulary_index(path)
        for b in batches:
            found = b.column(0).to_pylist()
            c = np.array([b.column(1 + k).to_numpy(zero_copy_only=False) for k in range(groups)]).reshape(groups, -1)
            total = c.sum(axis=0)
            lattice = np.zeros((groups, len(found)))
            for part, ids, bare in lattices(found, index):
                for k, own in enumerate(sent.value):
                    lattice[k, part] = forward(ids, bare, own)[0]
            lps = []
            for k, rest in enumerate(lattice):
                with np.errstate(divide="ignore"):
                    if n:  # the lattice's words and those of the whole corpus
                        corpus = np.logaddexp(np.log(np.maximum(total - cut, 0) / n), np.log(free / n) + rest)
                        rest = np.logaddexp(np.log1p(-CORPUS) + rest, np.log(CORPUS) + corpus)
                    if sizes[k]:
                        d, freed = cuts[k]
                        rest = np.logaddexp(np.log(np.maximum(c[k] - d, 0) / sizes[k]), np.log(freed / sizes[k]) + rest)
                lps.append(rest)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total), *map(pa.array, lps)], names=["unit", "c", *of_log])

    scored = bucketed(counted.mapInArrow(score_words, "unit string, c long" + "".join(f", {x} double" for x in of_log)), "unit", slot_count, "scored_words", dealt=True)
    answers = units.select("block", "local", "unit").join(scored, "unit").select("block", "local", "c", *of_log)

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            block = b.column(0).dictionary_encode()
            code = block.indices.to_numpy(zero_copy_only=False)
            local, c, *lps = (b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns))
            out = []
            for i, name in enumerate(block.dictionary.to_pylist()):
                at = code == i
                body = local[at].astype("<i4").tobytes() + c[at].astype("<i8").tobytes() + b"".join(lp[at].astype("<f8").tobytes() for lp in lps)
                out.append((name, int(at.sum()), compressor(1).compress(body)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["block", "entries", "body"])

    share = np.log10((ends + 0.5) / (n_ends + 0.5 * groups))
    end = np.where(sizes > 0, ends / np.maximum(sizes, 1), 0.0)
    end = np.where(end > 0, end, 0.5 if not n else 0.5 / (n + 1))
    floor = n + 0.5 * (v + 1)

    def assemble(left, right):
        import pyarrow as pa

        entries, bodies = right["entries"].to_pylist(), [decompressor().decompress(x) for x in right["body"].to_pylist()]
        size = sum(entries)
        counts, p = np.full(size, -1, np.int64), np.zeros((size, groups))
        for k, x in zip(entries, bodies, strict=True):
            local = np.frombuffer(x, "<i4", k)
            counts[local] = np.frombuffer(x, "<i8", k, 4 * k)
            p[local] = np.exp(np.frombuffer(x, "<f8", k * groups, 12 * k).reshape(groups, k).T)
        if size and counts.min() < 0:
            raise ValueError("a block lacks answers for some of its words")
        base, known_word = np.log10((counts + 0.5) / floor), counts > 0
        out = []
        for body in left["body"].to_pylist():
            at = numbers_of(body).astype(np.int64)
            (seen, distinct), i = history(at), np.arange(len(at))
            last = STRENGTH + DISCOUNT * distinct[-1]
            by_group = share + np.log10(last * end / (len(at) + STRENGTH))
            for a in range(0, len(at), SLICE):
                z = slice(a, a + SLICE)
                by_group = by_group + cached(at[z], p, seen[z], distinct[:-1][z], i[z]).sum(axis=0)
            top = by_group.max()
            score = top + np.log10((10.0 ** (by_group - top)).sum())
            out.append((len(at) + 1, int(known_word[at].sum()) + (n_ends > 0), float(base[at].sum()) + float(np.log10((n_ends + 0.5) / floor)), float(score)))
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.table({"doc_id": left["doc_id"], "held_out": pa.array([m < 0 for m in left["mark"].to_pylist()], pa.bool_()), "n_tokens": pa.array(cols[0], pa.int64()), "n_known": pa.array(cols[1], pa.int64()), "train_tokens": pa.array([n] * len(out), pa.int64()), "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64())})

    packed = answers.mapInArrow(pack, "block long, entries int, body binary")
    streams = both.where("kind = 'streams'").select("block", "doc_id", "mark", "body")
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return streams.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(assemble, result)
