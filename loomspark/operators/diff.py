"""Comparing the callers of one ORM method by their statements' fingerprints, and applying fixes.

Sets are arrays of distinct fingerprints per (orm_code, caller): one row a
caller, so the self-join on ``orm_code`` meets few rows on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def caller_sets(statements: DataFrame) -> DataFrame:
    """(orm_code, caller, sql_text, fp, seen) -> fps (sorted set), n_fp, n_sql, first_seen per caller; blank code is skipped."""
    return (
        statements.where("trim(orm_code) <> ''")
        .groupBy("orm_code", "caller")
        .agg(F.array_sort(F.collect_set("fp")).alias("fps"), F.count("*").alias("n_sql"), F.min("seen").alias("first_seen"))
        .withColumn("n_fp", F.size("fps"))
    )


def reference_callers(sets: DataFrame) -> DataFrame:
    """Of each method: the caller with most fingerprints, then most statements, then the first seen, which no two share. An aggregate, no sort."""
    best = F.max_by(F.struct("caller", "fps", "n_sql", "first_seen", "n_fp"), F.struct("n_fp", "n_sql", -F.col("first_seen")))
    return sets.groupBy("orm_code").agg(best.alias("r")).select("orm_code", "r.*")


def caller_diff(sets: DataFrame) -> DataFrame:
    """Every other caller against the reference: common, missing, extra, subset, superset, jaccard."""
    ref = reference_callers(sets).select("orm_code", F.col("caller").alias("reference"), F.col("fps").alias("ref_fps"))
    met = sets.join(ref, "orm_code").where("caller <> reference")
    common, union = F.array_intersect("fps", "ref_fps"), F.size(F.array_union("fps", "ref_fps"))
    missing, extra = F.array_except("ref_fps", "fps"), F.array_except("fps", "ref_fps")
    return met.select(
        "orm_code", "caller", "reference", "first_seen",
        F.array_sort(common).alias("common"), F.array_sort(missing).alias("missing"), F.array_sort(extra).alias("extra"),
        F.size(common).alias("n_common"), F.size(missing).alias("n_missing"), F.size(extra).alias("n_extra"),
        (F.size(extra) == 0).alias("is_subset"), (F.size(missing) == 0).alias("is_superset"),
        F.when(union == 0, 0.0).otherwise(F.size(common) / union).alias("jaccard"),
    )


def candidates(diffs: DataFrame) -> DataFrame:
    """redundant: a proper subset; new: something extra; missing: something missing. A proper subset is two candidates."""
    kinds = F.array_compact(F.array(F.when(F.col("is_subset") & (F.col("n_missing") > 0), "redundant"), F.when(F.col("n_extra") > 0, "new"), F.when(F.col("n_missing") > 0, "missing")))
    fps = F.when(F.col("type") == "redundant", F.col("common")).when(F.col("type") == "new", F.col("extra")).otherwise(F.col("missing"))
    return diffs.withColumn("type", F.explode(kinds)).select("orm_code", "caller", "reference", "type", fps.alias("fps"), "first_seen")


def candidate_queue(found: DataFrame, limit: int | None = None) -> DataFrame:
    """Numbered within each method in the order redundant, new, missing; at most ``limit`` of a type over all methods."""
    place = F.when(F.col("type") == "redundant", 0).when(F.col("type") == "new", 1).otherwise(2)
    queue = found.withColumn("place", place).withColumn("validation_no", F.row_number().over(Window.partitionBy("orm_code").orderBy("place", "first_seen", "caller")))
    queue = queue.withColumn("priority", F.when(F.col("type") == "missing", "medium").otherwise("high"))
    queue = queue.drop("place")
    if limit is None:
        return queue
    # each task keeps the first rows of a type, none sorts all of them
    first = [queue.where(F.col("type") == t).orderBy("orm_code", "validation_no").limit(limit) for t in ("redundant", "new", "missing")]
    return first[0].unionByName(first[1]).unionByName(first[2])


def mark_redundant(statements: DataFrame, found: DataFrame) -> DataFrame:
    """Adds is_redundant: the statement's fingerprint belongs to a redundant candidate of its caller."""
    bad = found.where("type = 'redundant'").select("orm_code", "caller", F.explode("fps").alias("fp")).distinct().withColumn("hit", F.lit(True))
    return statements.join(bad, ["orm_code", "caller", "fp"], "left").withColumn("is_redundant", F.coalesce("hit", F.lit(False))).drop("hit")


def fix_maps(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orm_code, caller, action, sql_text, accepted, replacement) -> (removals, additions).

    A removal that review didn't accept becomes an addition of its replacement, if it has one; review accepts by default.
    """
    accepted = F.coalesce("accepted", F.lit(True))
    key = ["orm_code", "caller"]
    removals = decisions.where((F.col("action") == "remove") & accepted).select(*key, "sql_text").distinct()
    added = decisions.where((F.col("action") == "add") & accepted).select(*key, "sql_text")
    replaced = decisions.where((F.col("action") == "remove") & ~accepted & F.col("replacement").isNotNull()).select(*key, F.col("replacement").alias("sql_text"))
    return removals, added.unionByName(replaced).distinct()


def apply_fixes(records: DataFrame, items: DataFrame, removals: DataFrame, additions: DataFrame, suffix: str) -> DataFrame:
    """record_id, statements: the suffix stripped, removed texts gone, additions at the end; records left empty go, others stay as they are."""
    key = ["orm_code", "caller"]
    touched = removals.select(*key).union(additions.select(*key)).distinct().withColumn("touched", F.lit(True))
    owners = records.select("record_id", *key).join(touched, key, "left").withColumn("touched", F.coalesce("touched", F.lit(False)))
    bare = F.when(F.col("touched") & F.endswith(F.col("sql_text"), F.lit(suffix)), F.expr(f"left(sql_text, length(sql_text) - {len(suffix)})")).otherwise(F.col("sql_text"))
    rows = items.join(owners, "record_id").withColumn("sql_text", bare).where("not touched or trim(sql_text) <> ''")
    kept = rows.join(removals.withColumn("gone", F.lit(True)), [*key, "sql_text"], "left").where("gone is null").select("record_id", "touched", "item_pos", "variant_pos", "sql_text")
    more = owners.where("touched").join(additions, key).select("record_id", "touched", F.lit((1 << 31) - 1).alias("item_pos"), F.lit(0).alias("variant_pos"), "sql_text")
    lists = kept.unionByName(more).groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("item_pos", "variant_pos", "sql_text"))).alias("l"))
    met = owners.join(lists, "record_id", "left").where("not touched or l is not null")
    return met.select("record_id", "touched", F.coalesce(F.transform("l", lambda s: s["sql_text"]), F.array().cast("array<string>")).alias("statements"))


def split_by_key(records: DataFrame, part: DataFrame, key: list[str]) -> DataFrame:
    """``records`` without those whose key occurs in ``part``."""
    return records.join(part.select(*key).distinct(), key, "left_anti")


def merge_back(base: DataFrame, processed: DataFrame, key: str, order: str, filled: list[str]) -> DataFrame:
    """The last processed row of a key wins; its null fields are filled from the base row; rows without one keep theirs."""
    last = processed.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("__k = 1")
    last = last.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in filled], F.lit(True).alias("processed"))
    met = base.join(last, key, "left")
    for c in filled:
        met = met.withColumn(c, F.coalesce(f"__{c}", c)).drop(f"__{c}")
    return met.withColumn("processed", F.coalesce("processed", F.lit(False)))


def compare_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, fp) twice -> common, missing (left only), extra (right only) per key of ``left``, with five counts; unmatched keys are marked."""
    a = left.groupBy(key).agg(F.collect_set("fp").alias("a"))
    b = right.groupBy(key).agg(F.collect_set("fp").alias("b"))
    met = a.join(b, key, "left").withColumn("matched", F.col("b").isNotNull()).withColumn("b", F.coalesce("b", F.array().cast("array<string>")))
    common, missing, extra = F.array_intersect("a", "b"), F.array_except("a", "b"), F.array_except("b", "a")
    return met.select(
        key, "matched",
        F.array_sort(common).alias("common"), F.array_sort(missing).alias("missing"), F.array_sort(extra).alias("extra"),
        F.size("a").alias("n_left"), F.size("b").alias("n_right"),
        F.size(common).alias("n_common"), F.size(missing).alias("n_missing"), F.size(extra).alias("n_extra"),
    )
