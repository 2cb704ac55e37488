"""Statement lists in their raw JSON form, value by value: for use inside tasks, over any text.

A list may be a text, a list of texts, objects and further lists, or one
object; what comes out keeps that form, so these are small recursions over one row's JSON.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text

DEPENDENT = "param_dependent"
# Fields that keep an object whose statement is gone; the scenario of an added variant; the mark of what is incomplete.
KEEPS = ("scenario", "description", "condition", "when")
ADDED = "补充的必要SQL"
#: Fields of positions, which examples go without.
POSITIONS = ("code_file", "code_version", "code_label", "code_type", "code_start_line", "code_end_line", "code_start_column")


def dumped(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def bare(s: str) -> str:
    return s.replace(text.REDUNDANT, "").strip()


def without(item, gone: set[str]):
    """An item of a list without the statements of ``gone``; None if nothing is left of it."""
    if isinstance(item, str):
        return bare(item) if bare(item) and bare(item) not in gone else None
    if isinstance(item, list):
        return [x for x in (without(i, gone) for i in item) if x is not None] or None
    if not isinstance(item, dict):
        return item
    if item.get("type") == DEPENDENT:
        left = [v for v in (_variant(w, gone) for w in item.get("variants") or []) if v is not None]
        return item | {"variants": left} if left else None
    own = item.get("sql")
    if isinstance(own, str) and bare(own) not in gone:
        return item | {"sql": bare(own)}
    if isinstance(own, list) and (left := without(own, gone)) is not None:
        return item | {"sql": left}
    return item if any(k in item for k in KEEPS) else None


def _variant(variant, gone: set[str]):
    own = variant.get("sql") if isinstance(variant, dict) else None
    if isinstance(own, str):
        return variant | {"sql": bare(own)} if bare(own) not in gone else None
    if isinstance(own, list):
        left = [bare(s) for s in own if isinstance(s, str) and bare(s) and bare(s) not in gone]
        return variant | {"sql": left} if left else None
    return variant


def fixed(value, gone: set[str], more: list[str]):
    """A whole list after removals and additions; None if the record is to go."""
    if isinstance(value, str):
        own = [] if value == text.NO_SQL or bare(value) in gone or not bare(value) else [bare(value)]
        whole = own + more
        return whole if len(whole) > 1 else whole[0] if whole else None
    if isinstance(value, list):
        return (without(value, gone) or []) + more or None
    if isinstance(value, dict):
        if value.get("type") != DEPENDENT:
            return without(value, gone)
        left = (without(value, gone) or {}).get("variants", []) + [{"scenario": ADDED, "sql": s} for s in more]
        return value | {"variants": left} if left else None
    return value


def pruned(value, fields: frozenset[str] = frozenset(POSITIONS)):
    """A JSON value without the named fields, at any depth."""
    if isinstance(value, dict):
        return {k: pruned(v, fields) for k, v in value.items() if k not in fields}
    return [pruned(v, fields) for v in value] if isinstance(value, list) else value


def marked(value):
    """A list whose incomplete statements carry the mark, those of variants too."""
    if isinstance(value, str):
        return text.INCOMPLETE + value if any(w in value for w in text.GAPS) else value
    if isinstance(value, list):  # lists inside it stay as they are
        return [v if isinstance(v, list) else marked(v) for v in value]
    if isinstance(value, dict) and isinstance(value.get("variants"), list):
        return value | {"variants": [v | {"sql": marked(v["sql"])} if isinstance(v, dict) and isinstance(v.get("sql"), str) else v for v in value["variants"]]}
    return value


def each_json(texts: pd.Series, change: Callable) -> pd.Series:
    """``change`` of every text that is JSON; others give null."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else dumped(change(json.loads(t)))
        except ValueError:
            return None

    return texts.map(one)


@F.pandas_udf(T.StringType())
def pruned_json(texts: pd.Series) -> pd.Series:
    return each_json(texts, pruned)


@F.pandas_udf(T.StringType())
def marked_json(texts: pd.Series) -> pd.Series:
    return each_json(texts, marked)


@F.pandas_udf(T.StringType())
def fixed_json(texts: pd.Series, gone: pd.Series, more: pd.Series) -> pd.Series:
    """Null where the record is to go; a text that isn't JSON stays as it is."""

    def one(t, g, m):
        try:
            new = fixed(json.loads(t), set(g), list(m))
        except (TypeError, ValueError):
            return t
        return None if new is None else dumped(new)

    return pd.Series([one(*x) for x in zip(texts, gone, more, strict=True)])
