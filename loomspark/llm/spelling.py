"""Spelling variants: a trie self-join with active-node sets, distance one.

The vocabulary's trie is partitioned by prefix. Two words at distance one, the
shorter of m letters, agree in their first or in their last m // 2 letters;
so each word goes to the subtrie below its first half and, read backwards, to the one
below its last half, once as the shorter word of a pair and once as the longer. A
cell is one such subtrie. There are no other cells to look into, and few words
share half of their letters.

Within a cell every trie node carries its active nodes, those whose prefix is
at distance one from its own (the node itself is the only one at distance
zero). They follow from the parent's alone: the parent, its other children, the
node's own children, and each of the parent's active nodes one equal letter
further down. Where a word ends, the active nodes at which words end are its near
words. Nodes are ranges of the cell's sorted words and are opened when a
set reaches them; below a node with a single word the rest of that word is looked up
behind each active node.

A cell of more than ``CELL`` words goes down one letter in Spark, by
equi-joins: pairs that differ in just this letter agree in all that
follows, so they meet by the rest of the word, in groups no larger than the
alphabet; pairs that agree in it meet again in the cell of the longer prefix. This goes on
until no cell is too large.

Forms rise in frequency at least twofold at every step, so following them ends
after at most log2 of the largest count; roots come by doubling.

Defined results: null texts have no words; a null identifier counts as an empty
one where words are spoilt; rows that repeat are counted each; other columns are
ignored; an empty table gives an empty result; a word of any length is a word.
"""

from __future__ import annotations

import itertools
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slots, stage

RUN = re.compile("[a-zÀ-ÿ]+")
OTHER = re.compile("[^A-Za-zÀ-ÿ]")
#: bytes.translate table that lower-cases A-Z alone; in UTF-8 no other character has such bytes.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: One in so many (document, word) pairs is spoilt; shortest word, fewest occurrences, and how much more frequent a form is.
SPOIL, LETTERS, OCCURRENCES, RATIO = 97, 5, 3, 2
#: Words of a cell in one task's hands; distinct words a task counts before it gives them out; characters cut into words at a time.
CELL, COUNTED, SLICE = 20_000, 200_000, 1 << 20


def runs(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of letters of a text, slice by slice."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            end = m.start() if (m := OTHER.search(text, end)) else len(text)
        part = text[at:end]
        yield RUN.findall(part.lower() if part.isascii() else part.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"))
        at = end


def spoilt(ident: str, run: str) -> str:
    """The run, or the run without one letter, as the check sum of identifier and run says."""
    h = zlib.crc32(f"{ident}:{run}".encode())
    if h % SPOIL:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the distinct words and how often they occur."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        total: dict[str, int] = {}
        for b in batches:
            for ident, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own: Counter = Counter()
                for found in runs(text):
                    own.update(found)
                for run, n in own.items():
                    if len(w := spoilt(ident, run)) >= letters:
                        total[w] = total.get(w, 0) + n
                if len(total) > COUNTED:
                    yield out()
                    total = {}
        if total:
            yield out()

    rows = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("ident"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


class Node:
    """A trie node: the sorted words from ``lo`` up to ``hi``, which share their first ``depth`` letters."""

    __slots__ = ("lo", "hi", "depth", "end", "kids")

    def __init__(self, lo: int, hi: int, depth: int):
        self.lo, self.hi, self.depth, self.end, self.kids = lo, hi, depth, -1, None


class Trie:
    def __init__(self, words: list[str]):
        """``words``: sorted and distinct."""
        self.words, self.number = words, {w: i for i, w in enumerate(words)}
        self.root = Node(0, len(words), 0)

    def open(self, node: Node) -> dict[str, Node]:
        """The node's children by letter; ``end`` is the word that ends here."""
        if node.kids is None:
            words, d, i, hi = self.words, node.depth, node.lo, node.hi
            if len(words[i]) == d:
                node.end = i
                i += 1
            node.kids = {}
            while i < hi:
                c = words[i][d]
                j = i + 1 if i + 1 == hi or words[i + 1][d] != c else bisect_left(words, chr(ord(c) + 1), i, hi, key=lambda w: w[d])
                node.kids[c] = Node(i, j, d + 1)
                i = j
        return node.kids

    def near(self) -> Iterator[tuple[int, int]]:
        """All (i, j), both ways round, with words i and j at distance one."""
        words, number, open_ = self.words, self.number, self.open
        todo = [(self.root, list(open_(self.root).values()))]
        while todo:
            node, active = todo.pop()
            kids = open_(node)
            if node.end >= 0:
                for v in active:
                    open_(v)
                    if v.end >= 0:
                        yield node.end, v.end
            for c, kid in kids.items():
                further = [w for v in active if (w := open_(v).get(c)) is not None and w is not kid]
                around = [node, *(w for w in kids.values() if w is not kid), *further]
                if kid.hi - kid.lo == 1:
                    rest = words[kid.lo][kid.depth :]
                    for j in {number.get(words[v.lo][: v.depth] + rest) for v in around} - {None, kid.lo}:
                        yield kid.lo, j
                else:
                    todo.append((kid, list(dict.fromkeys([*around, *open_(kid).values()]))))


def _cell(key: str, words: list[str], counts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """(word, how many near words the cell gives it, the most frequent one's count, that one)."""
    backwards, m, skip = key[0] == "b", int(key[1 : key.index(":")]), len(key) - key.index(":") - 1
    turned = sorted((w[::-1][skip:] if backwards else w[skip:], i) for i, w in enumerate(words))
    index = [i for _, i in turned]
    found: dict[int, tuple[int, int, str]] = {}
    for x, y in Trie([s for s, _ in turned]).near():
        i, j = index[x], index[y]
        a, b = words[i], words[j]
        # pairs of two longer words have a cell of their own; those alike in front are found forwards
        if min(len(a), len(b)) == m and not (backwards and a[: m // 2] == b[: m // 2]):
            n, best, form = found.get(i, (0, 0, ""))
            better = (-counts[j], b) < (-best, form)
            found[i] = (n + 1, *((counts[j], b) if better else (best, form)))
    for i, (n, best, form) in found.items():
        yield words[i], n, best, form


def _joined(batches: Iterator) -> Iterator:
    """Rows (key, word, n) sorted by key -> what the cells give. One cell is held at a time."""
    import pyarrow as pa

    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    out: list[tuple] = []
    for key, own in itertools.groupby(rows, lambda r: r[0]):
        cell = list(own)
        if len(cell) > 1:
            out += _cell(key, [w for _, w, _ in cell], [n for *_, n in cell])
        if len(out) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def cells(vocabulary: DataFrame, letters: int = LETTERS) -> DataFrame:
    """(key, word, n): a word's up to four cells. A key names direction, letters of the shorter word, and shared prefix."""
    size = F.char_length("word")
    found = [
        F.when(m >= letters, F.concat(F.lit(way), m, F.lit(":"), F.substring(text, F.lit(1), F.floor(m / 2).cast("int"))))
        for m in (size, size - 1)
        for way, text in (("f", F.col("word")), ("b", F.reverse("word")))
    ]
    return vocabulary.select(F.explode(F.array_compact(F.array(*found))).alias("key"), "word", "n")


def near_words(vocabulary: DataFrame, letters: int = LETTERS, cell: int = CELL) -> DataFrame:
    """(word, n_near, form_n, form): of words with near words, how many and the most frequent one. ``vocabulary``: (word, n), distinct."""
    n = slots(vocabulary.sparkSession)
    left, parts = cells(vocabulary, letters), []
    while True:
        large = stage(left.groupBy("key").count().where(F.col("count") > cell).select("key"), "large-cells")
        if large.isEmpty():
            break
        hot = stage(left.join(large, "key", "left_semi"), "large-cell-words")
        parts += [left.join(large, "key", "left_anti")]
        # one letter down: its place, the letter, and what follows
        turned = F.when(F.col("key").startswith("b"), F.reverse("word")).otherwise(F.col("word"))
        skip = F.char_length(F.substring_index("key", ":", -1))
        m = F.substring_index(F.expr("substring(key, 2)"), ":", 1).cast("int")
        rows = hot.withColumns({"m": m, "rest": F.substring(turned, skip + 1, F.char_length("word"))})
        rows = rows.withColumns({"letter": F.substring("rest", F.lit(1), F.lit(1)), "after": F.expr("substring(rest, 2)")})
        one = rows.where("letter <> ''").select("key", F.col("after").alias("meet"), "word", "n", "letter", "m")
        other = [F.col(c).alias(f"{c}2") for c in ("word", "n", "letter")]
        changed = one.join(one.select("key", "meet", *other), ["key", "meet"]).where((F.col("letter") != F.col("letter2")) & (F.char_length("word") == F.col("m")))
        longer = one.join(rows.select("key", F.col("rest").alias("meet"), *other), ["key", "meet"]).where((F.col("letter") != F.col("letter2")) & (F.char_length("word2") == F.col("m")))
        pairs = changed.unionByName(longer).unionByName(longer.select("key", "meet", F.col("word2").alias("word"), F.col("n2").alias("n"), "letter", "m", F.col("word").alias("word2"), F.col("n").alias("n2"), "letter2"))
        half = F.floor(F.col("m") / 2).cast("int")
        again = F.col("key").startswith("b") & (F.substring("word", F.lit(1), half) == F.substring("word2", F.lit(1), half))
        parts.append(pairs.where(~again).select("word", F.lit(1).cast("long").alias("n_near"), F.col("n2").alias("form_n"), F.col("word2").alias("form")))
        left = one.select(F.concat("key", "letter").alias("key"), "word", "n")
    found = [p if "n_near" in p.columns else _walked(p, n) for p in [*parts, left]]
    union = found[0]
    for p in found[1:]:
        union = union.unionByName(p)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return union.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _walked(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartition(n, "key").sortWithinPartitions("key", "word").mapInArrow(_joined, "word string, n_near long, form_n long, form string")


def roots(links: DataFrame) -> DataFrame:
    """(word, form), without circles -> (word, root): the last word that forms lead to."""
    now = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        now = after.select("word", "root")
        if after.where("went").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO, cell: int = CELL) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = stage(words(docs, id_col, text_col, letters, occurrences), "words")
    near = near_words(vocabulary, letters, cell)
    accepted = F.col("form_n") >= ratio * F.col("n")
    formed = stage(vocabulary.join(near, "word", "left").select("word", F.when(accepted, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(accepted, F.col("form_n")).alias("form_n")), "forms")
    last = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
