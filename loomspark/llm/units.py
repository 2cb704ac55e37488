"""Encoding with the tokenizers library, one distinct unit at a time.

The pre-tokenizers of both vocabularies never join across certain white
space, so a text is cut there, and each distinct unit is encoded once per
worker and remembered. The memory of a worker is bounded: a full table becomes
the older one, whose entries move back when they are asked for. Texts in which
a cut would not be safe go to the library whole.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array

#: Entries of a table that a worker remembers, besides as many older ones.
UNITS, PRETOKENS = 400_000, 100_000
#: The same of the byte-level vocabulary, whose ids are packed.
BYTE_UNITS = 1_000_000
#: Fixed value: the published pre-tokenizer pattern of the byte-level vocabulary.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODERS: dict = {}


def encoder(kind: type, path: str):
    """This worker's encoder of a vocabulary file."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Remembered(dict):
    """Values by key, made by ``make`` when they are first asked for; of a full table the latest entries stay."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> dict[int, int]:
    """Fixed rule of byte-level vocabularies: a byte's letter is its Latin-1 character if that is printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class ByteUnits:
    """Ids of the byte-level vocabulary as little-endian uint32 bytes.

    A space before a character that isn't white space always begins a
    pre-token: a run of white space gives up its last character, and that
    space opens the next one. So a text may be cut before each such space.
    Pre-tokens go straight to the library's model, which spares them the
    library's bookkeeping of offsets.
    """

    unsafe = re.compile(r" \s| \Z")
    #: Of plain ASCII texts, what makes a cut unsafe.
    unsafe_ascii = [" " + c for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f"]

    def __init__(self, path: str):
        import regex

        self.lib = library(path)
        self.tokenize, self.letters = self.lib.model.tokenize, byte_letters()
        if self.lib.normalizer is not None:
            raise ValueError("the vocabulary normalises texts, so its units can't be encoded apart")
        self.special = re.compile("|".join(re.escape(t.content) for t in self.lib.get_added_tokens_decoder().values()) or r"(?!)")
        self.pretokens = regex.compile(BYTE_LEVEL).findall
        self.known = Remembered(self.pretoken, PRETOKENS)
        #: By unit without its leading space.
        self.units = Remembered(self.unit, BYTE_UNITS)

    def unit(self, u: str) -> bytes:
        """Letters alone, or letters and one mark, need no pattern."""
        if u.isalpha():
            return self.pretoken(" " + u) if not u.isascii() else packed([t.id for t in self.tokenize("Ġ" + u)])
        if u[-1:] in (".", ",") and u[:-1].isalpha():
            return self.units[u[:-1]] + self.known[u[-1]]
        return b"".join([self.units[p[1:]] if p[0] == " " and p[1:].isalpha() else self.known[p] for p in self.pretokens(" " + u)])

    def pretoken(self, p: str) -> bytes:
        return packed([t.id for t in self.tokenize(p.encode().decode("latin-1").translate(self.letters))])

    def whole(self, text: str) -> bytes:
        return packed(self.lib.encode(text, add_special_tokens=False).ids)

    def cuttable(self, text: str) -> bool:
        unsafe = text[-1:] == " " or any(x in text for x in self.unsafe_ascii) if text.isascii() else self.unsafe.search(text)
        return not unsafe and not self.special.search(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, unit = [], self.units.__getitem__
        gc.disable()  # many small objects without cycles
        for t in texts:
            if self.cuttable(t):
                first, *rest = t.split(" ")
                out.append(self.whole(first) + b"".join(map(unit, rest)) if first else b"".join(map(unit, rest)))
            else:
                out.append(self.whole(t))
        gc.enable()
        return out


def packed(ids: list[int]) -> bytes:
    own = array("I", ids)
    if sys.byteorder == "big":
        own.byteswap()
    return own.tobytes()


class WordUnits:
    """Token counts of the lower-case vocabulary, which drops white space.

    Tokens hold no white space, and neither normalisation nor special strings
    reach across it; so counts of the units between spaces, tabs and line
    ends add up.
    """

    def __init__(self, path: str):
        self.lib = library(path)
        self.units = Remembered(lambda u: len(self.lib.encode(u, add_special_tokens=False).ids) if u else 0, UNITS + PRETOKENS)

    def count(self, text: str) -> int:
        return sum(map(self.units.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))
