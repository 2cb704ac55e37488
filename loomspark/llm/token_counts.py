"""Token counts, with overlap resynchronisation for huge documents.

Documents of up to ``2 * CHUNK`` characters are encoded in one piece. A longer
one is encoded in chunks that overlap, with offsets. Two chunks are spliced at
a position inside their overlap that is proven stable: it is white space,
which no token of this vocabulary spans, or the border between a letter and an
East Asian mark, where the pre-tokenizer always cuts; neither normalisation nor
pre-tokens nor special strings reach across either, and both encodings have the
same tokens at the same offsets between it and an earlier such position. Where the overlap has no such position it is widened, at last to
the whole chunk, which then is encoded together with the next one. So the
count is that of the library on the whole text, while no encoding call is
longer than the text's stretches without a stable position require.

Defined results: a null text counts as empty, with 0 bytes and tokens; rows
with null or repeated identifiers are counted one by one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .units import WordUnits, encoder

CHUNK = 16384
OVERLAP = 512
LIMIT = 2048
STABLE = " \t\n\r"
#: Marks of texts without spaces; none occurs in a special string.
EAST_ASIAN = "。，、！？；：「」『』（）《》"


def _tokens(lib, text: str, a: int, b: int) -> list[tuple[int, int, int]]:
    """(start, end, id) of the tokens of text[a:b], at places in the whole text."""
    e = lib.encode(text[a:b], add_special_tokens=False)
    return [(a + s, a + t, i) for (s, t), i in zip(e.offsets, e.ids, strict=True)]


def _splice(text: str, left: list, right: list, a: int, b: int) -> int | None:
    """The last stable position in text[a:b], the overlap, at which both token lists agree."""
    at = [p for p in range(a, b) if text[p] in STABLE or text[p] in EAST_ASIAN and p > a and text[p - 1].isalpha()]
    if len(at) < 2:
        return None
    first, last = at[0], at[-1]
    inside = lambda tokens: [t for t in tokens if t[0] >= first and t[1] <= last]
    crosses = lambda tokens: any(t[0] < p < t[1] for t in tokens for p in (first, last))
    return last if not crosses(left) and not crosses(right) and inside(left) == inside(right) else None


def long_ids(lib, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Token ids of a text of any length, spliced from overlapping chunks."""
    out: list[int] = []
    begin, start, end = 0, 0, min(chunk, len(text))  # tokens from `begin` on are still to be given out
    left = _tokens(lib, text, start, end)
    while end < len(text):
        wide, upto = overlap, min(end + chunk, len(text))
        while True:
            a = max(start, end - wide)
            if a == start:  # no stable position in the whole chunk: encode both together
                left, end = _tokens(lib, text, start, upto), upto
                break
            right = _tokens(lib, text, a, upto)
            if (p := _splice(text, left, right, a, end)) is not None:
                out += [i for s, t, i in left if s >= begin and t <= p]
                begin, start, end = p, a, upto
                left = right[bisect_left(right, (p,)) :]
                break
            wide *= 4
    return out + [i for s, _, i in left if s >= begin]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit. ``vocabulary``: path of a tokenizers file."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        units = encoder(WordUnits, vocabulary)
        for b in batches:
            texts = b.column(1).to_pylist()
            counts = [units.count(t) if len(t) <= 2 * chunk else len(long_ids(units.lib, t, chunk, overlap)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(scan, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
