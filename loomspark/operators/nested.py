"""Statements anywhere inside replies: JSON of any depth, JSON inside its strings, prose around it.

A round takes every value one level apart: a list into its items, an object
into what it holds, a string into the JSON that it is. Only values that are not
done go into the next round, so the work follows the data, whatever its
depth, and each round is a table in the shared folder. ``place`` tells where a
statement stood: the positions from the root down, in the order of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import code, text
from ..functions.json_text import items_at, kind, string_at, whole_json
from ..functions.responses import VERBS, statement_lines
from ..plans.staging import stage

MAP, TEXTS = "map<string,string>", "array<string>"
DEPENDENT = "param_dependent"


def nothing(of: str = TEXTS) -> Column:
    return F.array().cast(of)


def in_prose(c: Column) -> Column:
    """Statements of a text that isn't JSON: itself if it begins with a statement word, else its lines that do, else itself if it holds one anywhere."""
    words = "|".join(VERBS)
    some = F.coalesce(statement_lines(c), F.array(text.strip(c)))
    return F.when(text.strip(c) == "", nothing()).when(c.rlike(rf"(?is)^(?:{words})"), F.array(text.strip(c))).when(c.rlike(rf"(?i)(?:{words})"), some).otherwise(nothing())


def _apart(c: Column) -> Column:
    """(found, parts) of a text: the statements of prose, or the texts of a JSON value's parts in the order of the text.

    Of objects: the statements of the variants of a dependent one, else ``sql``
    alone, else all values. Numbers and truth values have no parts.
    """
    v = whole_json(c)
    fields = F.from_json(c, MAP)
    variants = F.transform(F.from_json(fields["variants"], TEXTS), lambda x: F.from_json(x, MAP)["sql"])
    has = lambda k: F.array_contains(F.map_keys(fields), k)
    of_object = F.when(F.coalesce(fields["type"] == DEPENDENT, F.lit(False)) & has("variants"), variants).when(has("sql"), F.array(fields["sql"])).otherwise(F.map_values(fields))
    parts = F.when(kind(v) == "ARRAY", F.from_json(c, TEXTS)).when(kind(v) == "OBJECT", of_object).when(kind(v) == "STRING", F.array(string_at(v)))
    return F.struct(F.when(v.isNull(), in_prose(c)).otherwise(nothing()).alias("found"), F.coalesce(parts, nothing()).alias("parts"))


def _rounds(todo: DataFrame, keys: list[str], apart: Callable[[Column], Column]) -> DataFrame:
    """Takes values apart until none is left; (keys, place, sql_text) of all statements found."""
    out = None
    while True:
        step = todo.select(*keys, "place", apart(F.col("value")).alias("x")).select(*keys, "place", "x.found", "x.parts")
        step = stage(step, "nested")
        own = step.select(*keys, "place", F.posexplode("found").alias("i", "sql_text")).select(*keys, F.concat("place", F.array("i")).alias("place"), "sql_text")
        out = own if out is None else out.unionByName(own)
        todo = step.select(*keys, "place", F.posexplode("parts").alias("i", "value")).where("value is not null").select(*keys, F.concat("place", F.array("i")).alias("place"), "value")
        if todo.isEmpty():
            return out


def statements(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, place, sql_text): a row for each statement inside a text column. Null texts have none."""
    start = rows.where(F.col(column).isNotNull()).select(*keys, nothing("array<int>").alias("place"), F.col(column).alias("value"))
    return _rounds(start, keys, _apart)


def _apart_loosely(v: Column) -> Column:
    """(found, parts) by the looser rule: every string that doesn't begin like JSON counts; objects give their ``sql``, their variants' and all their values."""
    s = string_at(v)
    opens = text.strip(s).rlike(r"^[\[{]")
    filled = lambda x: F.when(text.strip(x) != "", text.strip(x))
    from_variants = F.coalesce(F.transform(items_at(v, "$.variants"), lambda x: filled(string_at(x, "$.sql"))), nothing())
    found = F.when((kind(v) == "STRING") & ~opens, F.array(filled(s))).when(kind(v) == "OBJECT", F.concat(F.array(filled(string_at(v, "$.sql"))), from_variants)).otherwise(nothing())
    inner = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    parts = F.when(kind(v) == "ARRAY", items_at(v)).when(kind(v) == "OBJECT", inner).when((kind(v) == "STRING") & opens, F.array(whole_json(s)))
    return F.struct(F.array_compact(found).alias("found"), F.coalesce(parts, nothing("array<variant>")).alias("parts"))


def loose_statements(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, sql_text): the distinct statements by the looser rule, of a reply's JSON, or of its first balanced bracket, or the reply itself."""
    bare = text.strip(F.col(column))
    v = F.coalesce(whole_json(bare), whole_json(F.nullif(code.first_balanced(bare), F.lit(""))), F.when(bare != "", F.to_variant_object(F.array(bare))))
    start = rows.where(F.col(column).isNotNull()).select(*keys, nothing("array<int>").alias("place"), v.alias("value")).where("value is not null")
    return _rounds(start, keys, _apart_loosely).select(*keys, "sql_text").distinct()


def gathered(found: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, statements) of every row, in the order of their places."""
    per_row = found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sql_text"))), lambda x: x["sql_text"]).alias("statements"))
    return rows.select(*keys).join(per_row, keys, "left").select(*keys, F.coalesce("statements", nothing()).alias("statements"))

