"""Catalogs of fingerprints: building, matching, coverage.

A catalog has a row per (fingerprint, statement) in the order seen. It grows
with the corpus, so it is joined, and Spark chooses a broadcast only when its
statistics allow one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def build(fingerprinted: DataFrame, order: str) -> DataFrame:
    """(fp, n_sql, n_texts, first_sql): one row a fingerprint."""
    return fingerprinted.groupBy("fp").agg(F.count("*").alias("n_sql"), F.count_distinct("sql_text").alias("n_texts"), F.min_by("sql_text", order).alias("first_sql"))


def coverage(catalog: DataFrame, corpus: DataFrame) -> DataFrame:
    """One row: fingerprints of the catalog that aren't excluded, those that the corpus has, and their share."""
    valid = catalog.select("fp").where(~text.is_excluded(F.col("fp"))).distinct()
    seen = corpus.select("fp").distinct().withColumn("seen", F.lit(1))
    return valid.join(seen, "fp", "left").agg(F.count("*").alias("valid_catalog"), F.count("seen").alias("valid_matched")).withColumn("coverage", F.coalesce(F.try_divide("valid_matched", "valid_catalog"), F.lit(0.0)))


def coverage_of(statements: DataFrame, in_catalog: Column) -> DataFrame:
    """``coverage`` of one table whose rows belong to the catalog or to the corpus: one grouping, no join."""
    by_fp = statements.groupBy("fp").agg(F.bool_or(in_catalog).alias("cat"), F.bool_or(~in_catalog).alias("seen")).where(F.col("cat") & ~text.is_excluded(F.col("fp")))
    return by_fp.agg(F.count("*").alias("valid_catalog"), F.count_if("seen").alias("valid_matched")).withColumn("coverage", F.coalesce(F.try_divide("valid_matched", "valid_catalog"), F.lit(0.0)))


def match(units: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds ``in_catalog`` to (unit..., fp); the whole catalog matches, excluded classes too."""
    known = catalog.select("fp").distinct().withColumn("hit", F.lit(True))
    return units.join(known, "fp", "left").withColumn("in_catalog", F.coalesce("hit", F.lit(False))).drop("hit")


def units(matched: DataFrame) -> DataFrame:
    """Statements of an item roll up to one unit: wrapper, excluded, matched, unmatched or blank.

    A string is judged by itself; a group of variants is excluded if all of
    them are, and matched if any variant that isn't excluded or is in the
    catalog matches.
    """
    rows = matched.withColumn("blank", text.strip(F.coalesce("sql_text", F.lit(""))) == "").withColumn("wrapper", text.is_transaction_wrapper(F.col("sql_text")) & (F.col("item_kind") == "STRING")).withColumn("excluded", text.is_excluded(F.col("fp")))
    by_item = rows.groupBy("record_id", "item_pos").agg(F.bool_and("blank").alias("blank"), F.bool_or("wrapper").alias("wrapper"), F.bool_and("excluded").alias("excluded"), F.bool_or("in_catalog").alias("hit"))
    return by_item.withColumn("unit", F.when(F.col("blank"), "blank").when(F.col("wrapper"), "wrapper").when(F.col("excluded"), "excluded").when(F.col("hit"), "matched").otherwise("unmatched"))


def match_summary(found: DataFrame) -> DataFrame:
    """One row of counters and the guarded match rate."""
    n = lambda u: F.count_if(F.col("unit") == u)
    lines = found.groupBy("record_id").agg(F.bool_or(F.col("unit") == "matched").alias("any"))
    totals = found.agg(n("wrapper").alias("wrappers"), n("excluded").alias("excluded"), n("matched").alias("matched"), (n("matched") + n("unmatched")).alias("valid"))
    return totals.crossJoin(lines.agg(F.count_if("any").alias("matching_lines"))).withColumn("match_rate", F.coalesce(F.try_divide("matched", "valid"), F.lit(0.0)))


def unmatched(catalog: DataFrame, corpus: DataFrame) -> DataFrame:
    """Catalog fingerprints, excluded classes aside, that the corpus lacks, with their first statement."""
    return catalog.where(~text.is_excluded(F.col("fp"))).join(corpus.select("fp").distinct(), "fp", "left_anti").select("fp", "first_sql")


def coverage_by_type(catalog: DataFrame, corpus: DataFrame, kind: Column) -> DataFrame:
    """Coverage by statement type of a fingerprint's first statement, and over ALL."""
    seen = corpus.select("fp").distinct().withColumn("seen", F.lit(1))
    met = catalog.where(~text.is_excluded(F.col("fp"))).withColumn("sql_type", kind).join(seen, "fp", "left")
    out = met.rollup("sql_type").agg(F.count("*").alias("total"), F.count("seen").alias("matched"), F.grouping("sql_type").alias("g"))
    return out.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("sql_type")).alias("sql_type"), "total", "matched", F.try_divide("matched", "total").alias("coverage"))


def fallback_by_table(unknown: DataFrame, catalog: DataFrame) -> DataFrame:
    """(stmt_id, sql_type, tables) without a match -> the first catalog row with the first of its tables that has any, same type preferred."""
    mine = unknown.select("stmt_id", "sql_type", F.posexplode("tables").alias("pos", "table"))
    theirs = catalog.select(F.col("fp").alias("found_fp"), F.col("sql_type").alias("found_type"), "seen", F.explode("tables").alias("table"))
    first = theirs.groupBy("table", "found_type").agg(F.min_by("found_fp", "seen").alias("found_fp"), F.min("seen").alias("seen"))
    order = Window.partitionBy("stmt_id").orderBy("pos", F.desc(F.col("sql_type") == F.col("found_type")), "seen", "found_fp")
    return mine.join(first, "table").withColumn("k", F.row_number().over(order)).where("k = 1").select("stmt_id", "table", (F.col("sql_type") == F.col("found_type")).alias("same_type"), "found_fp")
