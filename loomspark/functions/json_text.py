"""JSON in text columns: whole values, kinds, fields. All built-in expressions over VARIANT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_json(c: Column) -> Column:
    """The text as a variant, null if it isn't one JSON value from end to end.

    Spark's reader stops after the first value. In brackets, a stray closing
    bracket would end that value early; as the field of an object, a stray
    brace would. Only one JSON value survives both.
    """
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")
    alone = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.when((F.size(items) == 1) & (F.size(F.map_keys(F.try_variant_get(alone, "$", "map<string,variant>"))) == 1), F.get(items, F.lit(0)))


def kind(v: Column, path: str = "$") -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID or a number's type; null if there is nothing."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), r"^(\w+)", 1)


def string_at(v: Column, path: str = "$") -> Column:
    """The string at a path; null for values of other kinds, which casting would turn into text."""
    return F.when(kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def items_at(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def keys(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


def missing(v: Column, *fields: str) -> Column:
    """Which fields an object hasn't got, in the order asked for; null values are there."""
    return F.array_except(F.array(*map(F.lit, fields)), keys(v))


def body(c: Column, shape: str) -> Column:
    """The JSON value that a reply is, or holds in its first json fence; ``shape``: the pattern of a fenced value."""
    fence = F.nullif(F.regexp_extract(c, rf"(?s){text.FENCE}json\s*({shape})\s*{text.FENCE}", 1), F.lit(""))
    return whole_json(F.when(c.contains(f"{text.FENCE}json"), fence).otherwise(text.strip(c)))
