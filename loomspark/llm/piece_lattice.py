"""SentencePiece encoding and decoding over a relational lattice.

Encoding works on the distinct units of a corpus. A text is cut before its
space marks, and then wherever two neighbouring characters stand side by side
in no piece: no segmentation ever crosses such a place. Every unit is exploded
into its substrings of two characters or more, an equi-join with the piece
table (a row a piece; broadcast, its size is that of the vocabulary) keeps
those that are edges of the unit's lattice, the edges are grouped by unit, and
a Spark ``aggregate`` folds them into the best segmentation:

* ``viterbi`` for unigram vocabularies: the segmentation of the largest summed
  score, of equal ones that with the longest last piece;
* ``merge`` for BPE vocabularies, whose library encoding is not the segmentation of
  the largest sum: each step joins the two neighbouring pieces that the
  best-scored edge covers, leftmost first, until no edge does so.

Substrings are bounded by the longest piece that begins with the same
``PREFIX`` characters. The folds keep the places where pieces meet as bits of
longs: one long for a unit of up to ``WORD`` characters, an array of
overlapping ones for any longer unit. A character that stands alone is named by
its code point until the answers are packed; there it becomes its own piece, or
its UTF-8 bytes' pieces if it has none.

Decoding joins ids to the piece table and puts texts together again, in the
same relational way (``decode``). While encoding, every document's ids are
decoded and compared with the text's CRC-32; a difference stops the query.

Defined results: null and empty texts have no ids; a text that holds the space
mark itself decodes to spaces there, as with the library, and is reported with
``round_trip`` false; null or repeated identifiers are encoded row by row; an
empty table gives an empty result; other columns are ignored. The steps of a
unit's merge fold grow with the square of its length, which matters only for
thousands of letters without space, mark or digit.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import BLOCK_CHARS, check_sum, gathered, numbers_of, planes, scan_blocks
from .common import bucketed, slots, small_table, stage, text_of

MARK = "▁"
#: Longest unit whose boundaries fit one long with a sign bit to spare.
WORD = 61
#: Boundaries that each long of a longer unit is ahead of the one before it; each holds 64.
STRIDE = 32
UNIT = re.compile(f"{MARK}+[^{MARK}]*")
#: An edge is packed as rank, start, length, id.
RANK_BITS, START_BITS, LENGTH_BITS, ID_BITS = 17, 24, 5, 17
PREFIX = 4
#: Units of a document put together at a time.
SLICE = 1 << 17


@lru_cache(4)
def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(4)
def pieces(path: str) -> tuple[list[tuple[str, int, float]], int]:
    """[(piece, id, score)] of the ordinary pieces, and the id of byte 0."""
    m = model(path)
    rows, byte0 = [], None
    for i in range(m.get_piece_size()):
        if m.is_byte(i):
            byte0 = i if byte0 is None else byte0
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            rows.append((m.id_to_piece(i), i, m.get_score(i)))
    if byte0 is None or m.id_to_piece(byte0) != "<0x00>":
        raise ValueError("the vocabulary has no byte pieces")
    for p, *_ in rows:
        if MARK in p.lstrip(MARK):
            raise ValueError(f"piece {p!r} would cross units")
    if max(len(p) for p, *_ in rows) >= STRIDE or max(i for _, i, _ in rows) >= 1 << min(ID_BITS, RANK_BITS):
        raise ValueError("pieces are too long, or too many, for the packed edges")
    return rows, byte0


def split_units(text: str) -> list[str]:
    """Units without the mark in front that each has: the library's normaliser puts one for every space and one at the start."""
    if text and text[0] != " " and "  " not in text and MARK not in text:  # every unit has one mark
        return text.split(" ")
    return [u[1:] for u in UNIT.findall(MARK + text.replace(" ", MARK))] if text else []


class Joints:
    """Which pairs of characters stand side by side in some piece."""

    def __init__(self, path: str):
        import numpy as np

        names = [p for p, *_ in pieces(path)[0] if len(p) > 1]
        chars = sorted({ord(c) for p in names for c in p})
        self.number = np.zeros(0x110000, np.int32)
        self.number[chars] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1) ** 2, bool)
        self.width = len(chars) + 1
        for p in names:
            for a, b in zip(p, p[1:], strict=False):
                self.joined[self.number[ord(a)] * self.width + self.number[ord(b)]] = True

    def cut(self, units: list[str]) -> tuple[list[str], object]:
        """(the parts of all units, each with its space mark in front, and how many each has)."""
        import numpy as np

        text = "".join([MARK + u for u in units])
        own = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        begins = np.ones(len(own), bool)
        begins[1:] = ~self.joined[own[:-1].astype(np.int64) * self.width + own[1:]]
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)))
        begins[starts[:-1]] = True
        cuts = np.flatnonzero(begins)
        ends = np.append(cuts[1:], len(own))
        return [text[a:b] for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)], np.diff(np.searchsorted(cuts, starts))


@lru_cache(4)
def joints(path: str) -> Joints:
    return Joints(path)


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(piece, id, score, rank): rank 0 is the best score, equal scores have equal ranks. A row a piece of the vocabulary."""
    rows, _ = pieces(path)
    ranks = {s: i for i, s in enumerate(sorted({s for *_, s in rows}, reverse=True))}
    return small_table(spark, [(p, i, float(s), ranks[s]) for p, i, s in rows], "piece string, id int, score double, rank int")


def reach_table(spark: SparkSession, path: str) -> DataFrame:
    """(prefix, reach): the longest piece that begins with the same ``PREFIX`` characters. Fewer rows than pieces."""
    reach: dict[str, int] = {}
    for p, *_ in pieces(path)[0]:
        if len(p) >= PREFIX:
            reach[p[:PREFIX]] = max(reach.get(p[:PREFIX], 0), len(p))
    return small_table(spark, list(reach.items()) or [("", 0)], "prefix string, reach int")


#: SQL of the parts of a packed edge ``e``; six bits are all that a short unit's start has.
SHIFT = f"cast(shiftright(e, {LENGTH_BITS + ID_BITS}) & 63 as int)"
START = f"cast(shiftright(e, {LENGTH_BITS + ID_BITS}) & {(1 << START_BITS) - 1} as int)"
LENGTH = f"cast(shiftright(e, {ID_BITS}) & {(1 << LENGTH_BITS) - 1} as int)"


def merge_fold(edges: str, n: str) -> Column:
    """The places where pieces meet, array<int> from 0 to ``n``, after joining neighbours in the order of rank, then place. SQL for its short lambdas.

    Each step takes one boundary away, so there are no more steps than edges
    or boundaries. A sign
    bit says that nothing is left to join; later steps then cost nothing.
    """
    # boundaries inside an edge and those at its ends
    end = f"shiftleft(shiftleft(1L, {SHIFT}), {LENGTH})"
    masks = f"named_struct('i', {end} - shiftleft(2L, {SHIFT}), 'b', {end} | shiftleft(1L, {SHIFT}))"
    joins = "bit_count(m & e.i) = 1 and (m & e.b) = e.b"
    # the first edge in order that joins two neighbours, if any does
    step = f"if(m < 0L, m, coalesce(m & ~get(filter(multi, e -> {joins}), 0).i, m | shiftleft(1L, 63)))"
    fold = f"aggregate(slice(multi, 1, least(size(multi), {n})), shiftleft(2L, {n}) - 1L, (m, i) -> {step}, m -> filter(sequence(0, {n}), p -> (m & shiftleft(1L, p)) <> 0L))"
    # bound once: an expression inside a lambda is worked out for every element
    short = f"get(transform(array(transform({edges}, e -> {masks})), multi -> {fold}), 0)"

    # the same with an array of longs: the k-th holds the boundaries from k * STRIDE on
    at, low = f"cast({START} div {STRIDE} as int)", f"({START} % {STRIDE})"
    masks = f"named_struct('w', {at}, 'i', shiftleft(1L, {low} + {LENGTH}) - shiftleft(2L, {low}), 'b', shiftleft(1L, {low}) | shiftleft(1L, {low} + {LENGTH}))"
    joins = "bit_count(get(s.m, e.w) & e.i) = 1 and (get(s.m, e.w) & e.b) = e.b"
    gone = "(get(s.m, e.w) & e.i)"
    taken = f"transform(s.m, (x, k) -> x & ~(case when k = e.w then {gone} when k = e.w - 1 then shiftleft({gone}, {STRIDE}) when k = e.w + 1 then shiftrightunsigned({gone}, {STRIDE}) else 0L end))"
    step = f"if(s.over, s, coalesce(get(transform(slice(filter(multi, e -> {joins}), 1, 1), e -> named_struct('m', {taken}, 'over', false)), 0), named_struct('m', s.m, 'over', true)))"
    all_set = f"transform(sequence(0, {n} div {STRIDE}), k -> shiftrightunsigned(-1L, cast(64 - least(64, {n} + 1 - {STRIDE} * k) as int)))"
    fold = f"aggregate(slice(multi, 1, least(size(multi), {n})), named_struct('m', {all_set}, 'over', false), (s, i) -> {step}, s -> filter(sequence(0, {n}), p -> (get(s.m, cast(p div {STRIDE} as int)) & shiftleft(1L, p % {STRIDE})) <> 0L))"
    long = f"get(transform(array(transform({edges}, e -> {masks})), multi -> {fold}), 0)"
    return F.expr(f"if({n} <= {WORD}, {short}, {long})")


def viterbi_fold(edges: str, n: str) -> Column:
    """The places where pieces meet, of the path of the largest summed score over ``edges`` of structs (b, a, score, id).

    The state holds, for each place reached so far, the best sum and where its
    last piece begins. Edges come by their ends, so a place is final before any
    edge leaves it; the path is walked back from the end.
    """
    init = f"named_struct('s', transform(sequence(0, {n}), p -> if(p = 0, 0D, double('-inf'))), 'f', transform(sequence(0, {n}), p -> -1))"
    better = "get(st.s, e.a) + e.score > get(st.s, e.b)"
    step = f"if({better}, named_struct('s', transform(st.s, (x, p) -> if(p = e.b, get(st.s, e.a) + e.score, x)), 'f', transform(st.f, (x, p) -> if(p = e.b, e.a, x))), st)"
    back = f"aggregate(sequence(1, {n}), array({n}), (path, i) -> if(get(path, 0) <= 0, path, concat(array(get(st.f, get(path, 0))), path)))"
    return F.expr(f"aggregate({edges}, {init}, (st, e) -> {step}, st -> {back})")


def encode_units(units: DataFrame, path: str, fold: str = "merge") -> DataFrame:
    """(unit), distinct and not null or empty, dealt by unit -> (unit, tokens array<int>), still so dealt.

    A token is a piece's id, or -1 less the code point of a character that stands alone.
    """
    spark = units.sparkSession
    rows, _ = pieces(path)
    longest = max(len(p) for p, *_ in rows)
    # an empty substring at each unit's start meets an empty piece, so that a unit without edges keeps its row
    none = small_table(spark, [("", None, None, None)], "piece string, id int, score double, rank int")
    known = F.broadcast(piece_table(spark, path).unionByName(none))
    starts = units.select("unit", F.length("unit").alias("n")).select("unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("a"))
    starts = starts.withColumn("prefix", F.substring("unit", F.col("a") + 1, F.lit(PREFIX))).join(F.broadcast(reach_table(spark, path)), "prefix", "left")
    most = F.least(F.coalesce("reach", F.lit(min(PREFIX - 1, longest))), F.col("n") - F.col("a"))
    # single characters are edges only where their scores count
    least = 2 if fold == "merge" else 1
    lengths = F.array(F.lit(0), *map(F.lit, range(least, longest + 1)))
    lengths = F.slice(lengths, F.when(F.col("a") == 0, 1).otherwise(2), F.greatest(most - least + 1, F.lit(0)) + F.when(F.col("a") == 0, 1).otherwise(0))
    spans = starts.select("unit", "a", F.explode(lengths).alias("len"))
    edges = spans.select("unit", "a", "len", F.substring("unit", F.col("a") + 1, F.col("len")).alias("piece")).join(known, "piece")
    packed = F.expr(f"shiftleft(cast(rank as long), {START_BITS + LENGTH_BITS + ID_BITS}) | shiftleft(cast(a as long), {LENGTH_BITS + ID_BITS}) | shiftleft(cast(len as long), {ID_BITS}) | id")
    by_rank = F.sort_array(F.collect_list(F.when(F.col("len") > 1, packed))).alias("edges")
    if fold == "merge":
        lattice = edges.groupBy("unit").agg(by_rank).withColumn("n", F.length("unit"))
        segment = merge_fold("edges", "n")
    else:
        by_end = F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct((F.col("a") + F.col("len")).alias("b"), "a", "score", "id"))))
        lattice = edges.groupBy("unit").agg(by_rank, by_end.alias("ends")).withColumn("n", F.length("unit"))
        # a character without a piece is an edge with the score of the worst piece less 10
        worst = min(s for *_, s in rows) - 10.0
        bare = f"transform(filter(sequence(0, n - 1), p -> not exists(ends, e -> e.a = p and e.b = p + 1)), p -> named_struct('b', p + 1, 'a', p, 'score', {worst}D, 'id', -1))"
        segment = viterbi_fold(f"sort_array(concat(ends, {bare}))", "n")
    places = F.expr(f"transform(edges, e -> cast(shiftright(e, {ID_BITS}) & {(1 << START_BITS + LENGTH_BITS) - 1} as int))")
    found = f"cast(get(q.e, cast(array_position(q.k, a * {1 << LENGTH_BITS} + b - a) as int) - 1) & {(1 << ID_BITS) - 1} as int)"
    tokens = f"zip_with(slice(q.c, 1, size(q.c) - 1), slice(q.c, 2, size(q.c) - 1), (a, b) -> if(b - a = 1, -1 - ascii(substring(unit, a + 1, 1)), {found}))"
    return lattice.withColumn("q", F.struct(segment.alias("c"), places.alias("k"), F.col("edges").alias("e"))).select("unit", F.expr(f"get(transform(array(q), q -> {tokens}), 0)").alias("tokens"))


@lru_cache(4)
def single_ids(path: str):
    """The id of each code point that is a piece, else -1; and the id of byte 0."""
    import numpy as np

    rows, byte0 = pieces(path)
    out = np.full(0x110000, -1, np.int32)
    for p, i, _ in rows:
        if len(p) == 1:
            out[ord(p)] = i
    return out, byte0


def resolved(path: str, tokens, lengths):
    """(ids, lengths) of lists of tokens laid end to end, with characters as pieces or bytes."""
    import numpy as np

    known, byte0 = single_ids(path)
    ids = np.where(tokens < 0, known[np.maximum(-1 - tokens, 0)], tokens)
    bare = np.flatnonzero(ids < 0)
    if not bare.size:
        return ids, lengths
    spelled = [[byte0 + b for b in chr(-1 - t).encode("utf-8", "surrogatepass")] for t in tokens[bare].tolist()]
    widths = np.ones(len(ids), np.int64)
    widths[bare] = list(map(len, spelled))
    ends = np.cumsum(widths)
    out = np.repeat(ids, widths)
    for at, own in zip((ends - widths)[bare].tolist(), spelled, strict=True):
        out[at : at + len(own)] = own
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lengths)))]
    return out, np.diff(bounds)


@lru_cache(4)
def spelling(path: str) -> dict[int, bytes]:
    """UTF-8 bytes of each id, space marks as spaces."""
    rows, byte0 = pieces(path)
    return {i: p.replace(MARK, " ").encode() for p, i, _ in rows} | {byte0 + b: bytes([b]) for b in range(256)}


@lru_cache(4)
def spelled_table(path: str):
    """The spellings of all ids laid end to end as bytes, where each begins, and how long it is."""
    import numpy as np

    found = spelling(path)
    rows = [found.get(i, b"") for i in range(max(found) + 1)]
    width = np.array(list(map(len, rows)), np.int64)
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum(width) - width, width


def encode(docs: DataFrame, path: str, fold: str = "merge", id_col: str = "doc_id", text_col: str = "text", from_files: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_pieces, ids array<int>, round_trip. ``path``: a SentencePiece model file.

    ``from_files``: ``docs`` is a table read from files, of which two scans see
    the same rows in the same partitions; any other input is written first.
    ``block_chars``: characters of text that a worker numbers the units of at a
    time; less of it takes less memory and repeats more units.
    """
    spark, n = docs.sparkSession, slots(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = (rows if from_files else stage(rows, "documents")).withColumn("mark", F.contains("text", F.lit(MARK)).cast("int"))

    def cut(units: list[str]) -> tuple:
        return joints(path).cut(units)

    units = bucketed(scan_blocks(rows, split_units, "units", cut=cut, block_chars=block_chars), "unit", n, "units")
    threshold = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(threshold)
    try:
        # units are grouped in memory up to this number a task, then by sorting
        spark.conf.set(threshold, str(1 << 18))
        known = bucketed(encode_units(units.select("unit").distinct(), path, fold), "unit", n, "encoded-units", dealt=True)
    finally:
        spark.conf.set(threshold, before)
    answers = units.join(known, "unit").select("block", "local", "tokens")

    def pack(batches: Iterator) -> Iterator:
        """Answers of a block, packed: numbers, lengths, ids."""
        import numpy as np
        import pyarrow as pa

        for b in batches:
            block = b.column(0).dictionary_encode()
            code = block.indices.to_numpy(zero_copy_only=False)
            local = b.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            lists = b.column(2).take(pa.array(order))
            values, lengths = resolved(path, lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()))
            ends = np.concatenate(([0], np.cumsum(lengths)))
            code, local = code[order], local[order]
            out = []
            for c, name in enumerate(block.dictionary.to_pylist()):
                a, z = np.searchsorted(code, [c, c + 1])
                body = np.concatenate((local[a:z].astype("<u4"), lengths[a:z].astype("<u4"), values[ends[a] : ends[z]].astype("<u4")))
                out.append((name, int(z - a), planes(body)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["block", "entries", "body"])

    def assemble(left, right):
        import numpy as np
        import pyarrow as pa

        # each unit's ids are flat[starts[unit]:][:counts[unit]], its text spelled[at[unit]:][:sizes[unit]]
        size = sum(right["entries"].to_pylist())
        starts, counts, parts, base = np.full(size, -1, np.int64), np.zeros(size, np.int64), [], 0
        for entries, body in zip(right["entries"].to_pylist(), right["body"].to_pylist(), strict=True):
            local, own, ids = np.split(numbers_of(body), [entries, 2 * entries])
            starts[local], counts[local] = base + np.cumsum(own, dtype=np.int64) - own, own
            parts.append(ids)
            base += len(ids)
        if size and starts.min() < 0:
            raise ValueError("a block lacks answers for some of its units")
        flat = np.concatenate(parts).astype("<i4") if parts else np.zeros(0, "<i4")
        letters, first, width = spelled_table(path)
        spelled = gathered(letters, first[flat], width[flat])
        bounds = np.concatenate(([0], np.cumsum(width[flat])))
        at = bounds[starts]
        sizes = bounds[starts + counts] - at
        streams, lengths = [], []
        for doc, crc, body in zip(left["doc_id"].to_pylist(), left["crc"].to_pylist(), left["body"].to_pylist(), strict=True):
            found, length, check, skipped = numbers_of(body), 0, 0, 1
            for k in range(0, len(found), SLICE):
                units = found[k : k + SLICE]
                streams.append(gathered(flat, starts[units], counts[units]))
                length += len(streams[-1])
                # the first space is the start mark
                check = zlib.crc32(gathered(spelled, at[units], sizes[units])[skipped:].tobytes(), check)
                skipped = 0
            lengths.append(length)
            if check != crc:
                raise ValueError(f"the ids of document {doc} don't decode to its text: the input's two scans differ")
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(streams) if streams else np.zeros(0, "<i4")))
        return pa.table({"doc_id": left["doc_id"], "n_pieces": pa.array(lengths, pa.int64()), "ids": ids, "round_trip": pa.array([not m for m in left["mark"].to_pylist()], pa.bool_())})

    packed = answers.mapInArrow(pack, "block long, entries int, body binary")
    # marks of the text itself decode to spaces
    streams = scan_blocks(rows, split_units, "streams", cut=cut, crc=lambda t: check_sum(t.replace(MARK, " ")), block_chars=block_chars).select("block", "doc_id", "mark", "crc", "body")
    return streams.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(assemble, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); rows with one identifier must be unique. Ids unknown to the table are an error.

    Ids are joined to the table of spellings as hex, so that byte pieces and
    ordinary ones are put together before they become text.
    """
    spelled = small_table(encoded.sparkSession, [(i, s.hex()) for i, s in spelling(path).items()], "id int, hex string")
    flat = encoded.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(ids_col).alias("pos", "id"))
    met = flat.join(F.broadcast(spelled), "id", "left")
    met = met.withColumn("hex", F.when(F.col("id").isNotNull() & F.col("hex").isNull(), F.raise_error(F.lit("an id has no piece")).cast("string")).otherwise(F.coalesce("hex", F.lit(""))))
    joined = met.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", "hex")))["hex"], "").alias("hex"))
    return joined.select("doc_id", F.decode(F.unhex(F.expr("substring(hex, 3)")), "utf-8").alias("text"))
