"""Evaluating generated statements against a catalog of fingerprints: from raw result rows to one line of counters.

A result row has statements of its own and of each of its callers. An item is
a statement, or a group of variants that counts as one unit. Rows become
units, units become counters: two groupings, the first by unit, the second over all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.fingerprint import fingerprint
from ..functions.json_text import items_at, keys, kind, string_at
from . import catalog

#: What a statement can be excluded for without counting under a name.
SYSTEM = "system_function"
WRAPPER = "transaction_wrapper"
DEPENDENT = "param_dependent"
NOTHING = "array<variant>"


def latest_rows(rows: DataFrame) -> DataFrame:
    """(sample_id, row): of rows (pos, row variant) with equal ``sample_id`` the last one counts; rows without one are named after their place."""
    name = F.coalesce(string_at(F.col("row"), "$.sample_id"), F.concat(F.lit("item_"), "pos"))
    return rows.withColumn("sample_id", name).groupBy("sample_id").agg(F.max_by("row", "pos").alias("row"))


def _as_list(v: Column) -> Column:
    """A list's items, a single value as a list of one, and nothing for what is empty or missing."""
    empty = (kind(v) == "VOID") | (F.coalesce(string_at(v), F.lit("x")) == "")
    return F.when(v.isNull() | empty, F.array().cast(NOTHING)).otherwise(F.coalesce(items_at(v), F.array(v)))


def statements(rows: DataFrame, field: str = "sql_statement_list") -> DataFrame:
    """(sample_id, place, variant, grouped, sql_text): the statements of (sample_id, row).

    ``place`` is [caller or -1 for the row's own, item]. A list-valued variant
    gives its first statement that isn't blank; blank statements and
    variants without any are left out, but a group stays a group, with a null text, if it has variants at all.
    """
    own = F.array(F.struct(F.lit(-1).alias("caller"), _as_list(F.try_variant_get("row", f"$.{field}", "variant")).alias("items")))
    callers = F.transform(F.coalesce(items_at(F.col("row"), "$.caller_results"), F.array().cast(NOTHING)), lambda v, i: F.struct(i.alias("caller"), _as_list(F.try_variant_get(v, f"$.{field}", "variant")).alias("items")))
    lists = rows.select("sample_id", F.explode(F.concat(own, callers)).alias("l"))
    items = lists.select("sample_id", "l.caller", F.posexplode("l.items").alias("i", "item"))
    group = (kind(F.col("item")) == "OBJECT") & (string_at(F.col("item"), "$.type") == DEPENDENT)
    filled = lambda s: F.when(text.strip(s) != "", s)
    first = lambda v: F.get(F.filter(F.transform(items_at(v, "$.sql"), lambda s: filled(string_at(s))), lambda s: s.isNotNull()), F.lit(0))
    variants = F.transform(items_at(F.col("item"), "$.variants"), lambda v: F.coalesce(filled(string_at(v, "$.sql")), first(v)))
    texts = F.when(group, variants).when(kind(F.col("item")) == "STRING", F.array(filled(string_at(F.col("item")))))
    found = items.select("sample_id", F.array("caller", "i").alias("place"), F.coalesce(group, F.lit(False)).alias("grouped"), F.posexplode(texts).alias("variant", "sql_text"))
    return found.where("grouped or sql_text is not null").withColumn("sql_text", text.strip(F.col("sql_text")))


def exclude_type(fp: Column) -> Column:
    """Why a fingerprint doesn't count, or null."""
    return F.when(text.is_excluded(fp), fp).when(fp.startswith("system_function_"), SYSTEM)


def judged(found: DataFrame, known: DataFrame) -> DataFrame:
    """``statements`` with fp, tables, why they are left out, and whether ``known`` (fp) has them."""
    wrapper = F.coalesce(text.is_transaction_wrapper(F.col("sql_text")), F.lit(False))
    fps = fingerprint(found).withColumn("excluded", F.when(wrapper, WRAPPER).otherwise(exclude_type(F.col("fp"))))
    return catalog.match(fps, known)


def unit_kinds(rows: DataFrame) -> DataFrame:
    """(sample_id, place, unit, fps, first_sql): one row a unit.

    A lone wrapper is no unit of any kind but ``wrapper``. A group is excluded
    if no variant is left, and matched if any that is left is in the catalog.
    """
    left = F.col("sql_text").isNotNull() & F.col("excluded").isNull()
    units = rows.groupBy("sample_id", "place", "grouped").agg(
        F.bool_or(left).alias("left"), F.bool_or(left & F.col("in_catalog")).alias("hit"), F.max(F.when(F.col("excluded") == WRAPPER, 1)).alias("wraps"),
        F.array_sort(F.collect_set(F.when(left & F.col("in_catalog"), F.col("fp")))).alias("fps"), F.min_by("sql_text", F.struct(F.col("sql_text").isNull(), "variant")).alias("first_sql"),
    )
    unit = F.when(~F.col("left") & ~F.col("grouped") & F.col("wraps").isNotNull(), "wrapper").when(~F.col("left"), "excluded").when(F.col("hit"), "matched").otherwise("unmatched")
    return units.select("sample_id", "place", "grouped", unit.alias("unit"), "fps", "first_sql")


def per_sample(units: DataFrame) -> DataFrame:
    """(sample_id, units): the units of each sample, nested, in their order."""
    return units.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("place", "unit", "fps"))).alias("units"))


def exclusions(rows: DataFrame) -> DataFrame:
    """(reason, n): how many statements were left out for each reason that counts by name."""
    return rows.where(F.col("excluded").isNotNull() & (F.col("excluded") != SYSTEM)).groupBy(F.col("excluded").alias("reason")).agg(F.count("*").alias("n"))


def official_count(row: Column, field: str = "sql_statement_list") -> Column:
    """The number of patterns that a row claims; the length of its list, or of its text, if it claims none; what isn't a whole number counts as 0."""
    claimed = F.coalesce(F.try_variant_get(row, "$.sql_pattern_cnt", "double").cast("long"), F.lit(0))
    own = F.coalesce(F.size(items_at(row, f"$.{field}")), F.length(string_at(row, f"$.{field}")), F.lit(0)).cast("long")
    return F.when(F.array_contains(keys(row), "sql_pattern_cnt"), claimed).otherwise(own)


def summary(rows: DataFrame, judged_rows: DataFrame, known: DataFrame) -> DataFrame:
    """One row of counters and guarded rates over the samples of ``latest_rows``."""
    n = lambda u: F.count_if(F.col("unit") == u)
    units = unit_kinds(judged_rows)
    counted = units.agg(n("matched").alias("matching"), (n("matched") + n("unmatched")).alias("valid"), n("excluded").alias("excluded"), F.count_distinct(F.when(F.col("unit") == "matched", F.col("sample_id"))).alias("matching_samples"))
    wrappers = judged_rows.agg(F.count_if(F.col("excluded") == WRAPPER).alias("wrappers"))
    samples = rows.agg(F.count("*").alias("samples"), F.coalesce(F.sum(official_count(F.col("row"))), F.lit(0)).alias("official"))
    seen = judged_rows.where("in_catalog and excluded is null").agg(F.count_distinct("fp").alias("matched_fps"))
    whole = known.agg(F.count_distinct("fp").alias("catalog_fps"))
    out = counted
    for one in (wrappers, samples, seen, whole):
        out = out.crossJoin(one)  # one row each
    rate = lambda a, b: F.coalesce(F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6), F.lit(0.0))
    return out.withColumn("match_rate", rate("matching", "valid")).withColumn("fp_coverage", rate("matched_fps", "catalog_fps"))


def coverage_report(units: DataFrame, statements_known: DataFrame) -> DataFrame:
    """One row: how unmatched units meet the catalog by table, and the rates that follow.

    ``units`` of ``unit_kinds``; ``statements_known``: the catalog's (seen, sql_text).
    A unit is looked up by its first statement. The adjusted rate leaves out
    units whose tables the catalog lacks; the combined one counts units that share table and type.
    """
    lost = units.where("unit = 'unmatched'").select(F.concat_ws("/", "sample_id", F.array_join("place", "/")).alias("stmt_id"), F.col("first_sql").alias("sql_text"))
    typed = lambda d: fingerprint(d).withColumn("sql_type", text.classify_sql(F.col("sql_text")))
    met = catalog.fallback_by_table(typed(lost), typed(statements_known.select("seen", "sql_text")))
    by_table = met.agg(F.count("*").alias("table_match"), F.count_if("same_type").alias("table_type_match"))
    n = lambda u: F.count_if(F.col("unit") == u)
    totals = units.agg(n("matched").alias("matching"), n("unmatched").alias("unmatched"))
    out = totals.crossJoin(by_table).withColumn("valid", F.col("matching") + F.col("unmatched")).withColumn("no_table", F.col("unmatched") - F.col("table_match"))
    rate = lambda a, b: F.coalesce(F.round(F.try_divide(a.cast("double"), b), 6), F.lit(0.0))
    return out.select(
        "matching", "unmatched", "valid", "table_match", "table_type_match", "no_table",
        rate(F.col("matching"), F.col("valid") - F.col("no_table")).alias("adjusted_rate"), rate(F.col("matching") + F.col("table_type_match"), F.col("valid")).alias("combined_rate"),
        rate(F.col("matching") + F.col("table_match"), F.col("valid")).alias("table_rate"),
    )


def match_lists(judged_rows: DataFrame, units: DataFrame, known: DataFrame) -> DataFrame:
    """(list, sample_id, sql_text, reason): the matched, unmatched and excluded statements, and the catalog's fingerprints that can't match."""
    lone = units.where("unit in ('matched', 'unmatched')").select(F.col("unit").alias("list"), "sample_id", F.col("first_sql").alias("sql_text"), F.lit(None).cast("string").alias("reason"))
    gone = judged_rows.where(F.col("excluded").isNotNull() & (F.col("excluded") != WRAPPER)).select(F.lit("excluded").alias("list"), "sample_id", "sql_text", F.col("excluded").alias("reason"))
    invalid = known.select("fp").distinct().where(exclude_type(F.col("fp")).isNotNull()).select(F.lit("invalid").alias("list"), F.lit(None).cast("string").alias("sample_id"), F.lit(None).cast("string").alias("sql_text"), F.col("fp").alias("reason"))
    return lone.unionByName(gone).unionByName(invalid)
