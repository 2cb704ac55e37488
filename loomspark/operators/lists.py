"""Statement lists in their raw form: fixes, forms of the sentinel, marks, patterns, and their text for prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rawlists, responses, text
from ..functions.json_text import items_at, kind, let, string_at, whole_json

NO_SQL_TYPE = "NO_SQL_GENERATE"


def fix_lists(records: DataFrame, removals: DataFrame, additions: DataFrame, keys: list[str], column: str = "statement_list") -> DataFrame:
    """Records whose key is in either map, with their list fixed; records left empty go, others stay as they are.

    ``removals`` and ``additions``: (keys, sql_text). A key's texts travel as one
    array: they are the fixes of one method's one caller.
    """
    own = lambda d, name: d.groupBy(*keys).agg(F.array_sort(F.collect_set("sql_text")).alias(name))
    maps = own(removals, "__gone").join(own(additions, "__more"), keys, "full").withColumn("touched", F.lit(True))
    met = records.join(maps, keys, "left").withColumn("touched", F.coalesce("touched", F.lit(False)))
    none = F.array().cast("array<string>")
    after = F.when(F.col("touched"), rawlists.fixed_json(column, F.coalesce("__gone", none), F.coalesce("__more", none))).otherwise(F.col(column))
    return met.withColumn(column, after).drop("__gone", "__more").where(F.col(column).isNotNull() | ~F.col("touched"))


def no_sql_forms(c: Column) -> Column:
    """Which forms of the sentinel a raw list has, as a struct: alone as a text; so or alone in a list; so or as an object of that type anywhere in a list."""

    def forms(v: Column) -> Column:
        alone = string_at(v) == text.NO_SQL
        listed = (F.size(items_at(v)) == 1) & (string_at(F.get(items_at(v), F.lit(0))) == text.NO_SQL)
        typed = F.exists(items_at(v), lambda x: F.coalesce(string_at(x, "$.type") == NO_SQL_TYPE, F.lit(False)))
        no = lambda x: F.coalesce(x, F.lit(False))
        return F.struct(no(alone).alias("one"), (no(alone) | no(listed)).alias("two"), (no(alone) | no(listed) | no(typed)).alias("three"))

    return let(whole_json(c), forms)


def marked_list(c: Column) -> Column:
    """A raw list with the mark on incomplete statements; a text that is no list is read as a malformed one first."""
    repaired = F.to_json(F.transform(responses.repaired_list(c), text.mark_incomplete))
    return F.when(kind(whole_json(c)) == "ARRAY", rawlists.marked_json(c)).otherwise(repaired)


def patterns(rows: DataFrame, column: str = "statement_list") -> DataFrame:
    """(pattern): the distinct texts of lists, and descriptions of their objects."""
    items = rows.select(F.explode(items_at(whole_json(F.col(column)))).alias("v"))
    found = items.select(F.coalesce(string_at(F.col("v")), F.try_variant_get("v", "$.description", "string")).alias("pattern"))
    return found.where("pattern is not null").distinct()


def variant_lines(c: Column) -> Column:
    """A raw list as numbered lines; variants are numbered by themselves and carry their scenario, or their number. A text is its own line."""
    shown = lambda v: F.coalesce(string_at(v), F.to_json(v))
    line = lambda i, s: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), s)

    def of_item(v: Column, i: Column) -> Column:
        named = lambda w, j: F.concat(F.coalesce(string_at(w, "$.scenario"), F.concat(F.lit("变体"), (j + 1).cast("string"))), F.lit(": "), F.coalesce(shown(F.try_variant_get(w, "$.sql", "variant")), F.lit("")))
        own = F.transform(F.coalesce(items_at(v, "$.variants"), F.array().cast("array<variant>")), lambda w, j: line(j, named(w, j)))
        return F.when(F.coalesce(string_at(v, "$.type") == rawlists.DEPENDENT, F.lit(False)), own).otherwise(F.array(line(i, shown(v))))

    def lines(v: Column) -> Column:
        found = F.flatten(F.transform(items_at(v), of_item))
        return F.coalesce(string_at(v), F.when(F.size(found) > 0, F.array_join(found, "\n")), F.to_json(v))

    return let(whole_json(c), lines)
