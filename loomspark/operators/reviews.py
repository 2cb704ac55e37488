"""Reviews of candidates and records: votes, decisions, recommendations, and summaries that have a row for what is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import items_at, kind, let, string_at, whole_json
from ..functions.text import FENCE, strip

# By type of candidate, the flag that a judge sets, the words of a reply without one, and what enough votes lead to, and too few.
FLAGS = {"redundant": "is_redundant", "new": "is_valid_new", "missing": "is_truly_missing"}
WORDS = {"redundant": "是，冗余", "new": "合理新增", "missing": "确实缺失"}
ACTIONS = {"redundant": ("remove", "keep"), "new": ("keep", "remove"), "missing": ("add", "keep")}
CONFIRMS = 0.6
LISTS = ("remove_redundant", "remove_wrong_new", "add_missing", "keep_disputed")


def confirms(reply: Column, kind_of: Column) -> Column:
    """Does a reply confirm a candidate? The flag of its type in a json fence is true; a reply without one has the type's words, or, of redundancy, begins with yes."""
    fence = F.nullif(F.regexp_extract(reply, rf"{FENCE}json\s*(\{{[^}}]+\}})\s*{FENCE}", 1), F.lit(""))
    flag = let(whole_json(fence), lambda v: F.coalesce(*[F.when(kind_of == t, (kind(v, f"$.{f}") == "BOOLEAN") & F.try_variant_get(v, f"$.{f}", "boolean")) for t, f in FLAGS.items()], F.lit(False)))
    plain = F.coalesce(*[F.when(kind_of == t, reply.contains(w)) for t, w in WORDS.items()]) | (kind_of == "redundant") & strip(reply).startswith("是")
    return F.coalesce(F.when(fence.isNotNull(), F.coalesce(flag, F.lit(False))).otherwise(plain), F.lit(False))


def decisions(votes: DataFrame, share: float = CONFIRMS) -> DataFrame:
    """(candidate, type, reply) -> (candidate, type, n, confirmed, decision): what a candidate's type leads to if enough votes confirm it, or else."""
    counted = votes.withColumn("ok", confirms(F.col("reply"), F.col("type"))).groupBy("candidate", "type").agg(F.count("*").alias("n"), F.count_if("ok").alias("confirmed"))
    enough = F.col("confirmed") >= share * F.col("n")
    return counted.withColumn("decision", F.coalesce(*[F.when(F.col("type") == t, F.when(enough, yes).otherwise(no)) for t, (yes, no) in ACTIONS.items()]))


def recommendations(decided: DataFrame) -> DataFrame:
    """``decided`` (type, decision, ...) with ``list``: which list of recommendations a candidate goes to."""
    d = lambda t, a: (F.col("type") == t) & (F.col("decision") == a)
    return decided.withColumn("list", F.when(d("redundant", "remove"), LISTS[0]).when(d("new", "remove"), LISTS[1]).when(d("missing", "add"), LISTS[2]).otherwise(LISTS[3]))


def recommendation_counts(listed: DataFrame) -> DataFrame:
    """(list, n) of every list, and their total."""
    counted = listed.rollup("list").agg(F.count("*").alias("n")).select(F.coalesce("list", F.lit("total_candidates")).alias("list"), "n")
    names = listed.sparkSession.createDataFrame([(n,) for n in (*LISTS, "total_candidates")], "list string")
    return names.join(counted, "list", "left").na.fill(0, ["n"])


def totals_by(parts: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """(key, candidates, removed, added, kept) of every part; zeros where it has no candidates."""
    n = lambda a: F.count_if(F.col("decision") == a)
    counted = decided.groupBy(key).agg(F.count("*").alias("candidates"), n("remove").alias("removed"), n("add").alias("added"), n("keep").alias("kept"))
    return parts.join(counted, key, "left").na.fill(0, ["candidates", "removed", "added", "kept"])


def control_flow_summary(judged: DataFrame) -> DataFrame:
    """One row over (is_correct, unreadable, statements): how many verdicts are errors, correct, incorrect, how many of the incorrect have a regenerated list, and the share that is correct."""
    error = F.coalesce("unreadable", F.lit(True))
    right, wrong = ~error & F.col("is_correct"), ~error & ~F.col("is_correct")
    out = judged.agg(F.count("*").alias("detected"), F.count_if(right).alias("correct"), F.count_if(wrong).alias("incorrect"), F.count_if(error).alias("error"), F.count_if(wrong & F.col("statements").isNotNull()).alias("regenerated"))
    return out.withColumn("rate", F.coalesce(F.round(F.try_divide(F.col("correct").cast("double"), F.col("detected")), 6), F.lit(0.0)))


def reanalysis_summary(rows: DataFrame) -> DataFrame:
    """One row over (failed, skipped, result): analyses that failed, were left out by the precheck, went through, and of these how many now have statements.

    A result is a list whose first object says that nothing was to be generated before.
    """
    first = F.get(items_at(whole_json(F.col("result"))), F.lit(0))
    flag = F.lower(strip(F.coalesce(string_at(first, "$.should_generate_sql"), F.try_variant_get(first, "$.should_generate_sql", "string"))))
    new = (kind(first) == "OBJECT") & (flag == "false")
    done = ~F.col("failed") & ~F.col("skipped")
    out = rows.agg(F.count("*").alias("processed"), F.count_if("failed").alias("failed"), F.count_if(~F.col("failed")).alias("succeeded"), F.count_if(~F.col("failed") & F.col("skipped")).alias("skipped"), F.count_if(done).alias("analysed"), F.count_if(done & F.coalesce(new, F.lit(False))).alias("newly_generated"))
    return out.withColumn("still_without", F.col("analysed") - F.col("newly_generated"))
