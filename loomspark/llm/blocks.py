"""Texts as numbered units of a block's own vocabulary.

Looking up a corpus-wide table for every word of every text would shuffle all
word occurrences. Instead the scan's partitions are cut into blocks of bounded
size. A block numbers its distinct units in the order in which they first
occur, so frequent ones have small numbers; only (block, number, unit) rows are
joined to the table, and the answers, packed, meet the block's documents, which
travel as compressed number streams. No join key is hotter than the number of
blocks.

A block's name is its partition and its number inside it. Where the two kinds
of rows come from two scans, both must see the same rows in the same
partitions: that holds for a table read from files. Each document's check sum
guards the result.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compressor, decompressor

#: Characters of text in a block, about.
BLOCK_CHARS = 32 << 20
#: Units cut at a time, and rows of a batch that are Python objects at a time.
CUT, ROWS = 1 << 15, 256
STREAMS = "block long, doc_id long, mark int, n long, crc long, body binary"


def units_schema(marks: int) -> str:
    return "block long, local int, unit string" + "".join(f", n{k} long" for k in range(marks))


def planes(ids) -> bytes:
    """Whole numbers below 2^32, compressed byte plane by byte plane."""
    import numpy as np

    return compressor(3).compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def numbers_of(body: bytes):
    """The numbers that ``planes`` packed."""
    import numpy as np

    raw = np.frombuffer(decompressor().decompress(body), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1) if raw.size else np.zeros(0, "<u4")


def gathered(flat, starts, lengths):
    """flat[starts[0]:starts[0] + lengths[0]], flat[starts[1]: ...], ... as one array."""
    import numpy as np

    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Block:
    """Documents of one block: their units get numbers as they come; documents keep those, not their units."""

    def __init__(self, name: int, cut: Callable | None):
        self.name, self.cut, self.size = name, cut, 0
        self.numbers: dict[str, int] = defaultdict(itertools.count().__next__)
        self.docs: list[tuple] = []

    def numbered(self, found: list[str]):
        import numpy as np

        return np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found))

    def parts(self):
        """(distinct parts in order, their numbers unit by unit, where a unit begins in those, how many it has)."""
        import numpy as np

        whole = list(self.numbers)
        if self.cut is None:
            n = np.arange(len(whole), dtype=np.uint32)
            return whole, n, n.astype(np.int64), np.ones(len(whole), np.int64)
        numbers: dict[str, int] = defaultdict(itertools.count().__next__)
        flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(whole), CUT):
            pieces, own = self.cut(whole[i : i + CUT])
            flat.append(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)))
            lengths.append(own)
        counts = np.concatenate(lengths)
        return list(numbers), np.concatenate(flat), np.cumsum(counts) - counts, counts

    def units_out(self, marks: int) -> Iterator:
        """Batches of (block, local, unit) and the occurrences in documents of each mark."""
        import numpy as np
        import pyarrow as pa

        found, flat, starts, lengths = self.parts()
        counts = np.zeros((marks, len(found)), np.int64)
        for k in range(marks):
            own = [ids for _, mark, _, ids in self.docs if mark == k]
            if own:
                ids = np.concatenate(own)
                counts[k] = np.bincount(gathered(flat, starts[ids], lengths[ids]), minlength=len(found))
        for i in range(0, len(found), 10000):
            some = found[i : i + 10000]
            yield [pa.array(np.full(len(some), self.name, np.int64)), pa.array(np.arange(i, i + len(some), dtype=np.int32)), pa.array(some, pa.string()), *(pa.array(c[i : i + 10000]) for c in counts)]

    def streams_out(self) -> Iterator:
        """Batches of (block, doc_id, mark, n, crc, body)."""
        import pyarrow as pa

        _, flat, starts, lengths = self.parts()
        for i in range(0, len(self.docs), 1000):
            out = []
            for doc, mark, crc, ids in self.docs[i : i + 1000]:
                own = gathered(flat, starts[ids], lengths[ids])
                out.append((self.name, doc, mark, len(own), crc, planes(own)))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]


def check_sum(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def scan_blocks(rows: DataFrame, split: Callable[[str], list[str]], kind: str, marks: int = 0, cut: Callable | None = None, crc: Callable[[str], int] = check_sum, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``rows``: (doc_id, text, mark). ``kind``: "units", "streams" or "both".

    Units: a row for each distinct unit of a block, with its occurrences in
    rows of each mark from 0 to ``marks`` - 1 (n0, n1, ...). Streams: a row for
    each document with its mark, the numbers of its units, their count, and
    a check sum of its text. Both: one scan gives both, told apart by ``kind``.

    ``block_chars``: characters of text in a block, about; both scans of a table need the same.

    ``split`` cuts a text; ``cut``, if given, takes the list of a block's
    distinct results and cuts each into further units: (all of these, how many
    each result has).
    """
    stream_names = [f.split()[0] for f in STREAMS.split(", ")]
    unit_names = ["block", "local", "unit", *(f"n{k}" for k in range(marks))]

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows_of(columns: list, names: list[str], own: str) -> pa.RecordBatch:
            if kind != "both":
                return pa.RecordBatch.from_arrays(columns, names=names)
            given = dict(zip(names, columns, strict=True)) | {"kind": pa.array([own] * len(columns[0]), pa.string())}
            return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(len(columns[0]), f.type)) for f in both], schema=both)

        both = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("local", pa.int32()), ("unit", pa.string()), *((f"n{k}", pa.int64()) for k in range(marks)), ("doc_id", pa.int64()), ("mark", pa.int32()), ("n", pa.int64()), ("crc", pa.int64()), ("body", pa.binary())])

        def out(block: Block) -> Iterator:
            if kind != "streams":
                yield from (rows_of(c, unit_names, "units") for c in block.units_out(marks))
            if kind != "units":
                yield from (rows_of(c, stream_names, "streams") for c in block.streams_out())

        only_units = kind == "units" and not marks
        block = None
        pa.default_memory_pool().release_unused()  # of the worker's earlier tasks
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            for place, doc, text, mark in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block is None or block.size > block_chars:
                    if block:
                        yield from out(block)
                    block = Block(block.name + 1 if block else place, cut)
                block.size += len(text)
                found = split(text)
                if only_units:
                    for u in dict.fromkeys(found):
                        block.numbers[u]
                else:
                    block.docs.append((doc, mark, crc(text) if kind != "units" else 0, block.numbered(found)))
        if block:
            yield from out(block)

    # the low bits are left to the running number of a block within its partition
    place = F.shiftleft(F.spark_partition_id().cast("long"), 32)
    schema = {"units": units_schema(marks), "streams": STREAMS, "both": f"kind string, {units_schema(marks)}, {STREAMS.removeprefix('block long, ')}"}[kind]
    return rows.select(place.alias("at"), "doc_id", "text", "mark").mapInArrow(scan, schema)
