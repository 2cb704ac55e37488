"""BPE encoding by speculation and verification, and decoding.

Merging a word step by step is replaced by a proposal and a proof. The proposal
is the greedy longest match over the tokens that merging can reach at all. The
proof is pairwise: a sequence of reachable tokens is what merging gives exactly
when no two neighbours would ever be joined across their border, and that can
be told from the two tokens alone, by undoing their own merges from the latest
back to the first (``Vocabulary.compatible``). All neighbours of a batch are
checked at once, as arrays; only words with a failing border are merged, with a
heap, in n log n steps for a word of n letters.

Texts are cut at spaces, tabs and line ends, which neither normalisation nor
pre-tokens nor special strings reach across. Every worker remembers the ids of
the units it met, in two generations of bounded size; each batch first learns
all its new units together and is then put together from them. Long texts go
through in slices, so that a text is never held as a list of its units.

Defined results: a null or empty text has no ids and decodes to the empty text;
special strings inside texts become their special tokens, as the library's
default has it; rows with null or repeated identifiers are encoded one by one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import text_of
from .units import byte_letters, library, packed

#: Units in a generation of a worker's memory; characters of text taken apart at a time; rows of a batch at a time.
UNITS, SLICE, ROWS = 400_000, 1 << 20, 256
#: Added to the last letter of a word: letters that end a word are symbols of their own.
LAST = 0x10000
#: Fixed value: the published pre-tokenizer pattern of the lower-case vocabulary, with the letters and numbers below U+0130 spelt out.
SIMPLE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-įÀ-ÖØ-Þ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-įÀ-ÖØ-Þ0-9²³¹¼-¾]+"
#: Letters from here on may change under normalisation, or in number when lower-cased.
SIMPLE = "\u0130"
NEVER = 1 << 40
#: Letters of a word up to which merging looks through all pairs at each step.
SHORT = 64


class Vocabulary:
    """Tokens, merges and the pairwise proof of a BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import numpy as np

        with open(path, encoding="utf-8") as f:
            given = json.load(f)["model"]
        if given["type"] != "BPE" or any(given.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError("the file isn't a plain BPE vocabulary")
        self.suffix = given.get("end_of_word_suffix") or ""
        self.ids = {self._own(t): i for t, i in given["vocab"].items()}
        self.size = n = max(self.ids.values()) + 1
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        keys = np.zeros(len(given["merges"]), np.int64)
        for r, pair in enumerate(given["merges"]):
            a, b = map(self._own, pair if isinstance(pair, list) else pair.split(" "))
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            if self.rank[z] >= 0 or max(self.rank[x], self.rank[y]) >= r:
                raise ValueError("a token has two merges, or comes before its parts")
            self.rank[z], self.left[z], self.right[z], keys[r] = r, x, y, x * n + y
        if any(len(t) > 1 and self.rank[i] < 0 for t, i in self.ids.items()):
            raise ValueError("a token of several letters has no merge")
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.results = np.flatnonzero(self.rank >= 0)[np.argsort(self.rank[self.rank >= 0])].tolist()
        self.merges = {k: r for r, k in enumerate(keys.tolist())}
        # tokens that merging their own letters gives back: only these can be proposed
        sound = self.compatible(self.left, self.right, np.where(self.rank < 0, 0, self.rank))
        while not (better := sound & sound[self.left] & sound[self.right] == sound).all():
            sound &= better
        self.reachable = {t: i for t, i in self.ids.items() if sound[i]}
        self.reach: dict[str, int] = {}
        for t in self.reachable:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))

    def _own(self, token: str) -> str:
        """A token's letters; the one in front of the end-of-word mark is another symbol."""
        return last(token.removesuffix(self.suffix)) if self.suffix and token.endswith(self.suffix) and token != self.suffix else token

    def compatible(self, a, b, limit=None):
        """Whether merging the letters of tokens ``a`` and ``b`` (arrays) never joins something across their border.

        ``limit``: merges from this number on don't count. Time runs backwards:
        of the two tokens at the border the one made later is taken apart.
        Until then the border's pair must not have had its turn. Of equal
        merges the left one is done first: the border comes after the merge
        that makes the left token, but before the one that makes the right.
        """
        import numpy as np

        a, b = np.array(a), np.array(b)
        ok, at = np.ones(len(a), bool), np.arange(len(a))
        until = np.full(len(a), NEVER) if limit is None else np.array(limit)
        while at.size:
            pair = a * self.size + b
            where = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            joined = (self.keys[where] == pair) & (self.ranks[where] < until)
            ok[at[joined]] = False
            ra, rb = self.rank[a], self.rank[b]
            undo_left = ra > rb
            until = np.where(undo_left, ra, rb + 1)
            going = ~joined & (np.maximum(ra, rb) >= 0)
            a, b = np.where(undo_left, self.right[a], a)[going], np.where(undo_left, b, self.left[b])[going]
            at, until = at[going], until[going]
        return ok

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the reachable tokens."""
        out, i, n = [], 0, len(word)
        found, reach = self.reachable.get, self.reach.get
        while i < n:
            j = min(n, i + reach(word[i : i + 2], 1))
            while (t := found(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def merge(self, word: str) -> list[int]:
        """The merges in their order: lowest number first, of equal ones the leftmost."""
        ids = [self.ids[c] for c in word]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def merge_short(self, ids: list[int]) -> list[int]:
        size, turn, results = self.size, self.merges.get, self.results
        turns = [turn(x * size + y, NEVER) for x, y in itertools.pairwise(ids)]
        while turns and (r := min(turns)) != NEVER:
            i = turns.index(r)
            ids[i] = results[r]
            del ids[i + 1], turns[i]
            if i:
                turns[i - 1] = turn(ids[i - 1] * size + ids[i], NEVER)
            if i < len(turns):
                turns[i] = turn(ids[i] * size + ids[i + 1], NEVER)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of the pairs' turns: n log n steps."""
        n, size, turn, results = len(ids), self.size, self.merges.get, self.results
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, x, y) for i, (x, y) in enumerate(itertools.pairwise(ids)) if (r := turn(x * size + y)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = results[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n and (s := turn(ids[p] * size + ids[q])) is not None:
                    heapq.heappush(heap, (s, p, ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def encode(self, words: list[str]) -> tuple[list[list[int]], int]:
        """(ids of each word, how many words had to be merged)."""
        import numpy as np

        out = [[t] if (t := self.reachable.get(w)) is not None else self.propose(w) for w in words]
        several = [k for k, ids in enumerate(out) if len(ids) > 1]
        if not several:
            return out, 0
        sizes = np.fromiter((len(out[k]) for k in several), np.int64, len(several))
        flat = np.fromiter(itertools.chain.from_iterable(out[k] for k in several), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(several)), sizes)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[which]
        failing = np.unique(word[inner[~good]])
        for k in failing.tolist():
            out[several[k]] = self.merge(words[several[k]])
        return out, len(failing)


def last(letters: str) -> str:
    """The letters of a whole word: the last one ends it."""
    return letters[:-1] + chr(ord(letters[-1]) + LAST) if letters else letters


class Encoder:
    """This worker's memory: units between white space and their ids, as bytes of 32-bit numbers."""

    def __init__(self, path: str):
        self.words, self.lib, self.letters = Vocabulary(path), library(path), byte_letters()
        special = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in self.lib.get_added_tokens_decoder().values()):
            raise ValueError("special strings would reach across units")
        self.special, self.cut = special, re.compile("(" + "|".join(map(re.escape, special)) + ")" if special else "((?!))")
        self.hint = os.path.commonprefix(list(special))
        self.plain = re.compile(SIMPLE_WORDS).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pretokens(self, unit: str) -> list[str]:
        """Words of a unit in byte letters, the last letter marked."""
        if unit.isprintable() and max(unit) < SIMPLE:
            lower = unit.lower()
            words = [lower] if lower.isalpha() else self.plain(lower)
            return list(map(last, words if lower.isascii() else [w.encode().decode("latin-1").translate(self.letters) for w in words]))
        return [last(w) for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(unit)) if w]

    def parts(self, unit: str) -> list:
        """Words and ids of special tokens, in order."""
        out: list = []
        for k, part in enumerate(self.cut.split(unit) if self.hint in unit else [unit]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out += self.pretokens(part)
        return out

    def learn(self, units: set[str]) -> None:
        """From now on ``known`` has these units."""
        from array import array

        if len(self.known) > UNITS:
            self.known, self.older = {}, self.known
        new = []
        for u in units:
            if u not in self.known:
                if (ids := self.older.get(u)) is None:
                    new.append(u)
                else:
                    self.known[u] = ids
        gc.disable()  # many small lists without cycles
        taken = [self.parts(u) for u in new]
        words = list({w for own in taken for w in own if isinstance(w, str)})
        ids = dict(zip(words, map(packed, self.words.encode(words)[0]), strict=True))
        for u, own in zip(new, taken, strict=True):
            self.known[u] = ids[own[0]] if len(own) == 1 and isinstance(own[0], str) else b"".join([ids[w] if isinstance(w, str) else packed([w]) for w in own])
        gc.enable()

    def encode(self, text: str) -> bytes:
        out = []
        for units in slices(text):
            self.learn(set(units))
            out.append(b"".join(map(self.known.__getitem__, units)))
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Short texts learn their units together."""
        short = [k for k, t in enumerate(texts) if len(t) <= SLICE]
        out: list[bytes] = [b""] * len(texts)
        for group in grouped(short, [len(texts[k]) for k in short]):
            cut = [units_of(texts[k]) for k in group]
            self.learn(set().union(*cut))
            for k, units in zip(group, cut, strict=True):
                out[k] = b"".join(map(self.known.__getitem__, units))
        for k, t in enumerate(texts):
            if len(t) > SLICE:
                out[k] = self.encode(t)
        return out


def grouped(items: list[int], sizes: list[int]) -> Iterator[list[int]]:
    """Runs of items of about ``SLICE`` characters together."""
    run, total = [], 0
    for item, size in zip(items, sizes, strict=True):
        run.append(item)
        total += size
        if total > SLICE:
            yield run
            run, total = [], 0
    if run:
        yield run


def units_of(text: str) -> list[str]:
    """Between spaces, tabs and line ends; any white space separates, but only these are certain not to be joined with their neighbours."""
    return [u for u in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if u]


def slices(text: str) -> Iterator[list[str]]:
    """The units of a text, those of about ``SLICE`` characters at a time."""
    at, n, border = 0, len(text), re.compile(r"[ \t\n\r]")
    while at < n:
        end = n if at + SLICE >= n else (m.start() if (m := border.search(text, at + SLICE)) else n)
        yield units_of(text[at:end])
        at = end


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def token_strings(path: str):
    """The library's string of every id, as an array of objects."""
    import numpy as np

    lib = library(path)
    if lib.decoder is not None:
        raise ValueError("the file has a decoder of its own")
    return np.array([lib.id_to_token(i) or "" for i in range(lib.get_vocab_size(with_added_tokens=True))], object)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (array<int>). ``vocabulary``: path of a tokenizers BPE file."""

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = encoder(vocabulary)
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            found = own.encode_all(b.column(1).to_pylist())
            sizes = np.fromiter((len(x) // 4 for x in found), np.int64, len(found))
            flat = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with one more column ``decoded``, the text of its ids with special tokens; null ids give the empty text."""
    fields = [f.name for f in encoded.schema.fields]
    at = fields.index(ids_col)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        strings = token_strings(vocabulary)
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            own = b.column(at)
            flat, sizes = own.flatten().to_numpy(zero_copy_only=False), own.value_lengths().fill_null(0).to_pylist()
            texts, start = [], 0
            for n in sizes:
                texts.append(" ".join(strings[flat[start : start + n]].tolist()))
                start += n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*fields, "decoded"])

    if "decoded" in fields:
        raise ValueError("the table has a column decoded already")
    return encoded.mapInArrow(scan, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))

