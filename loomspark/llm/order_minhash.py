"""Document fingerprints by Order MinHash, in DataFrame functions alone.

The k-mers of a text are runs of ``K`` words, numbered by occurrence. A word of
more than ``WORD`` characters counts as its characters instead, one by one, so that texts
without spaces have k-mers too. Their
order is that of a 34-bit hash of (k-mer, number), which for a k-mer's first
occurrence is the k-mer's own; occurrences are numbered by sorting hashes with
positions and counting inside equal ones. The hash also deals the numbered
k-mers into ``BINS`` bins. In each bin the ``PICKS`` smallest are selected and
put back in text order, and the tuple of the k-mers, without their numbers, is
hashed to 16 bits: the bin's value. As order counts, the likeness
of two fingerprints, the share of equal values among bins that either fills,
falls with edit distance, not only with k-mer overlap. One pass over the
k-mers serves all bins, and a hash, its bin, its position and its occurrence
all lie in one sortable long.

The next document in descending order of identifiers is found without a
global sort: identifiers are cut into cells of about ``CELL`` documents, at most ``CELLS``
of them, at approximate quantiles, so clustered identifiers fill no cell beyond the others. An
identifier that fills several cells by itself, and null ones, are cut by their texts' hashes.
Texts move once, to their cell; inside it a window finds the
next one. Each cell's last document meets the first of the next cell that has
any, one row a cell, and the order of cells is found by ranges of cells: inside
a range by a window, between ranges by a row a range.

Defined results: a null text counts as empty; a text without words fills no
bin and is like another such text (1.0) and unlike any other (0.0); a text of
fewer than K words has one k-mer, all its words; a null identifier stands
after all others; rows that repeat an identifier follow one another by a hash
of the text; a table of one document is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slots, stage, text_of

K = 2
BINS_LOG2 = 6
PICKS = 2
CELL = 1024
#: Cells at most; the square of what a look-up goes through at each of its two steps.
CELLS = 128 * 128
#: Longest word that is one unit.
WORD = 24
#: Above any part of a cell.
TOP = 1 << 20
SPACE = "[\\x20\\x09-\\x0D]+"
#: No text has as many words: a string has less than 2^31 bytes.
POSITION = (1 << 30) - 1
#: Stands for a bin without k-mers in the printed fingerprint.
NO_KMER = "----"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shifted(array: Column, by: int, none: Column) -> Column:
    """The array moved ``by`` places to the right, filled with ``none``, of the same length."""
    return F.slice(F.concat(F.array_repeat(none, by), array), F.lit(1), F.size(array))


def signature(text: Column, k: int = K, bins_log2: int = BINS_LOG2, picks: int = PICKS) -> Column:
    """array<int> with the value of every bin, null where no k-mer falls."""
    no_long = F.lit(None).cast("long")
    spaced = F.array_remove(F.split(text, SPACE), "")
    long = lambda w: F.length(w) > WORD
    words = let(spaced, lambda ws: F.when(F.exists(ws, long), F.flatten(F.transform(ws, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))).otherwise(ws))

    def kmers(hashes: Column) -> Column:
        last = F.size(hashes) - F.lit(k - 1)
        runs = [F.slice(hashes, F.lit(i + 1), last) for i in range(k)]
        joined = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)), runs[1:], runs[0])
        short = F.array(F.xxhash64(F.concat_ws(" ", F.transform(hashes, lambda h: h.cast("string")))))
        return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).when(F.size(hashes) < k, short).otherwise(joined)

    in_bin = lambda x: F.shiftright(x, 64 - bins_log2)
    hashed = lambda x: x.bitwiseAND(F.lit(~POSITION))
    at = lambda x: x.bitwiseAND(F.lit(POSITION))

    def packed(runs: Column) -> Column:
        return F.transform(runs, lambda x, i: hashed(x).bitwiseOR(i.cast("long")))

    def marked(in_order: Column, again: bool) -> Column:
        # the members whose hash the one before them has, or those where it's new
        same = F.zip_with(in_order, shifted(in_order, 1, no_long), lambda x, y: F.when((y.isNotNull() & (hashed(x) == hashed(y))) == F.lit(again), x))
        return F.filter(same, lambda x: x.isNotNull())

    def renumbered(more: Column) -> Column:
        # sorted further occurrences: equal hashes are a run, in which the place tells the occurrence
        starts = F.filter(F.transform(more, lambda x, i: F.when((i == 0) | (hashed(x) != hashed(F.get(more, i - 1))), i)), lambda i: i.isNotNull())
        runs = lambda s: F.transform(s, lambda i, k: F.slice(more, i + 1, F.coalesce(F.get(s, k + 1), F.size(more)) - i))
        return F.flatten(F.transform(let(starts, runs), lambda run: F.transform(run, lambda x, j: hashed(F.xxhash64(hashed(x), j + 1)).bitwiseOR(at(x)))))

    def numbered(in_order: Column) -> Column:
        # a first occurrence keeps its k-mer's hash, the others get one of (k-mer, number)
        return F.concat(marked(in_order, False), let(marked(in_order, True), lambda m: F.when(F.size(m) == 0, m).otherwise(renumbered(m))))

    def select(in_order: Column) -> Column:
        # a member is among the smallest of its bin if the one `picks` places before it is of another bin
        marked = F.zip_with(in_order, shifted(in_order, picks, no_long), lambda x, y: F.when(y.isNull() | (in_bin(x) != in_bin(y)), x))
        return F.filter(marked, lambda x: x.isNotNull())

    def values(picked: Column, runs: Column) -> Column:
        # members of a bin are neighbours; sorted by position, each stands for its k-mer alone; the entry is (bin, hash of the tuple)
        starts = F.filter(F.transform(picked, lambda x, i: F.when((i == 0) | (in_bin(x) != in_bin(F.get(picked, i - 1))), i)), lambda i: i.isNotNull())
        members = lambda i: F.filter(F.slice(picked, i + 1, F.lit(picks)), lambda x: in_bin(x) == in_bin(F.get(picked, i)))
        groups = F.transform(starts, lambda i: F.struct(in_bin(F.get(picked, i)).alias("b"), F.array_sort(F.transform(members(i), lambda x: F.struct(at(x).alias("at"), F.get(runs, at(x).cast("int")).alias("h"))))["h"].alias("t")))
        entry = F.map_from_entries(F.transform(groups, lambda g: F.struct(g["b"], F.pmod(F.xxhash64(g["t"]), F.lit(1 << 16)).cast("int"))))
        half = 1 << (bins_log2 - 1)
        return let(entry, lambda m: F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), lambda b: F.element_at(m, b.cast("long"))))

    def whole(runs: Column) -> Column:
        return let(let(F.sort_array(let(F.sort_array(packed(runs)), numbered)), select), lambda picked: values(picked, runs))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), kmers), whole)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those that either fills; 1.0 if neither fills any."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), None).otherwise(x.eqNullSafe(y)))
    return let(F.filter(both, lambda e: e.isNotNull()), lambda e: F.when(F.size(e) == 0, 1.0).otherwise(F.size(F.filter(e, lambda v: v)) / F.size(e)))


def printed(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda v: F.coalesce(F.lower(F.lpad(F.hex(v), 4, "0")), F.lit(NO_KMER))), "")


def edited(text: Column, following: Column) -> Column:
    """The text with its last third (floor, in code points) replaced by the first as many of the following one."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def next_cell(cells: DataFrame, n: int) -> DataFrame:
    """(cell) -> (cell, next): the largest cell below, and after the last one the first."""
    ranged = stage(cells.repartitionByRange(n, "cell").withColumn("part", F.spark_partition_id()), "cells")
    down = F.lead("cell").over(Window.partitionBy("part").orderBy(F.desc("cell")))
    tops = ranged.groupBy("part").agg(F.max("cell").alias("top"))  # a row a range, as many as partitions
    order = Window.orderBy(F.desc("part"))
    tops = tops.select("part", F.coalesce(F.lead("top").over(order), F.first("top").over(order)).alias("beyond"))
    return ranged.withColumn("down", down).join(F.broadcast(tops), "part").select("cell", F.coalesce("down", "beyond").alias("next"))


def cell_of(docs: DataFrame, ident: Column, text: Column) -> Column:
    """The number of a document's cell: greater for greater identifiers, below 0 for null ones."""
    total = docs.agg(F.count(ident).alias("n"), F.count_if(ident.isNull()).alias("none")).first()
    # a power of two of hash ranges for null identifiers
    bits = max(0, (total["none"] // CELL).bit_length())
    by_hash = F.shiftright(F.xxhash64(text), 64 - bits) + F.lit(1 << (bits - 1)) if bits else F.lit(0).cast("long")
    without = -1 - by_hash
    parts = min(CELLS, total["n"] // CELL)
    if parts < 2:
        return F.when(ident.isNull(), without).otherwise(F.lit(0).cast("long"))
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(ident, shares, 20 * parts).alias("q")).first()["q"]
    bounds = sorted(set(found))  # CELLS at most
    # a bound that comes up m times is an identifier on the rows of about m cells: it is cut into as many hash ranges
    times = [max(0, (found.count(b) - 1).bit_length()) if found.count(b) > 1 else 0 for b in bounds]
    step = int(len(bounds) ** 0.5) + 1
    array = lambda xs, kind: F.array(*[F.lit(x).cast(kind) for x in xs])
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= ident))
    coarse, fine = array(bounds[::step], "long"), array(bounds, "long")
    # in two steps: the last coarse bound that isn't above, then the bounds from there on
    place = let(upto(coarse), lambda c: F.when(c == 0, 0).otherwise((c - 1) * step + upto(F.slice(fine, (c - 1) * step + 1, F.lit(step)))))

    def whole(k: Column) -> Column:
        own, cut = F.get(fine, k - 1), F.get(array(times, "int"), k - 1)
        one = F.lit(1).cast("long")
        in_hash = F.call_function("shiftright", F.xxhash64(text), 64 - cut) + F.call_function("shiftleft", one, cut - 1)
        part = F.when(F.coalesce(cut, F.lit(0)) == 0, 0).when(ident == own, F.call_function("shiftleft", one, cut) - 1 - in_hash).otherwise(TOP)
        return k.cast("long") * (2 * TOP) + part

    return F.when(ident.isNull(), without).otherwise(let(place, whole))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    n = slots(docs.sparkSession)
    ident, text = F.col(id_col).cast("long"), text_of(text_col)
    base = docs.select(ident.alias("doc_id"), text.alias("text"), cell_of(docs, ident, text).alias("cell"))
    base = base.repartition(n, "cell").withColumn("sig", signature(F.col("text")))
    order = Window.partitionBy("cell").orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    met = base.select("*", F.lead("text").over(order).alias("following"), F.lead("sig").over(order).alias("next_sig"), F.lag(F.lit(1)).over(order).isNull().alias("is_first"))
    met = met.withColumn("is_last", F.col("following").isNull()).withColumn("edit", edited(F.col("text"), F.col("following")))
    rows = stage(
        met.select(
            "doc_id", "cell", "sig", "next_sig", "is_first", "is_last",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"),
            F.when(~F.col("is_last"), signature(F.col("edit"))).alias("edited_sig"),
            F.when(F.col("is_first"), F.col("text")).alias("first_text"),
            F.when(F.col("is_last"), F.col("text")).alias("last_text"),
        ),
        "order-minhash",
    )
    firsts = rows.where("is_first").select(F.col("cell").alias("next"), F.col("first_text").alias("following"), F.col("sig").alias("next_sig"))
    nexts = next_cell(rows.where("is_first").select("cell"), n)
    lasts = rows.where("is_last").drop("next_sig").join(nexts, "cell").join(firsts, "next").withColumn("edit", edited(F.col("last_text"), F.col("following")))
    lasts = lasts.withColumn("edited_sha256", F.sha2(F.col("edit").cast("binary"), 256)).withColumn("edited_sig", signature(F.col("edit")))
    kept = ["doc_id", "n_chars", "edited_sha256", "sig", "edited_sig", "next_sig"]
    return rows.where("not is_last").select(*kept).unionByName(lasts.select(*kept)).select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("sig")).alias("fingerprint"), printed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
