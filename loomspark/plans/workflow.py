"""The whole curation of records as a pipeline of steps, each a table; replies of models come in as tables.

Records: record_id, orm_code, caller, code_value, list_state. From the second
step on they carry ``statements``, their list as an array. Steps: keyword
tagging, cleaning, completeness, correctness, review of callers' differences
with its fixes, control flow with regenerated lists, keywords by reply, split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import responses, text
from ..functions.fingerprint import fingerprint
from ..operators import clean, diff, reviews, sampling
from .pipeline import Pipeline, curation
from .staging import stage

PLACES = 1 << 16


@dataclass
class Replies:
    """What models said: (record_id, reply) tables, and votes (orm_code, caller, type, reply) on each candidate of a review."""

    completeness: DataFrame
    votes: DataFrame
    control_flow: DataFrame
    regenerated: DataFrame
    keywords: DataFrame


def reviewed(records: DataFrame, votes: DataFrame) -> DataFrame:
    """Records after the review of their callers: what was confirmed as redundant or wrong is gone, what is missing is there, records left empty are gone."""
    found = records.select("record_id", "orm_code", "caller", F.posexplode("statements").alias("item_pos", "sql_text"))
    rows = stage(fingerprint(found).select("record_id", "orm_code", "caller", "item_pos", "sql_text", "fp", (F.col("record_id") * PLACES + F.col("item_pos")).alias("seen")), "reviewed")
    candidates = diff.candidates(diff.caller_diff(diff.caller_sets(rows)))
    decided = reviews.decisions(votes.withColumn("candidate", F.struct("orm_code", "caller"))).select("candidate.orm_code", "candidate.caller", "type", "decision")
    met = stage(candidates.join(decided, ["orm_code", "caller", "type"]).select("orm_code", "caller", "reference", "decision", F.explode("fps").alias("fp")), "decided")
    gone = met.where("decision = 'remove'").join(rows, ["orm_code", "caller", "fp"]).select("orm_code", "caller", "sql_text").distinct()
    theirs = rows.groupBy("orm_code", F.col("caller").alias("reference"), "fp").agg(F.min_by("sql_text", "seen").alias("sql_text"))
    more = met.where("decision = 'add'").join(theirs, ["orm_code", "reference", "fp"]).select("orm_code", "caller", "sql_text").distinct()
    fixed = diff.apply_fixes(records, rows.select("record_id", "item_pos", F.lit(0).alias("variant_pos"), "sql_text"), gone, more, text.REDUNDANT)
    return records.drop("statements").join(fixed.withColumnRenamed("touched", "reviewed"), "record_id")


def flow_checked(records: DataFrame, verdicts: DataFrame, regenerated: DataFrame) -> DataFrame:
    """Records with a verdict on their control flow; a regenerated list takes the place of an incorrect one. What can't be read counts as correct."""
    said = verdicts.select("record_id", responses.verdict(F.col("reply")).alias("v"))
    again = regenerated.select("record_id", responses.regenerated(F.col("reply")).alias("new"))
    met = records.join(said, "record_id", "left").join(again, "record_id", "left").withColumn("flow", text.has_control_flow(F.col("orm_code")))
    correct = ~F.col("flow") | F.coalesce(F.col("v.is_correct"), F.lit(True))
    return met.withColumn("flow_correct", correct).withColumn("statements", F.when(~F.col("flow_correct") & F.col("new").isNotNull(), F.col("new")).otherwise(F.col("statements"))).drop("v", "new")


def workflow(items: DataFrame, replies: Replies, folder: str, val_ratio: float = 0.1) -> Pipeline:
    def review(records: DataFrame) -> DataFrame:
        return reviewed(records, replies.votes)

    def flow(records: DataFrame) -> DataFrame:
        return flow_checked(records, replies.control_flow, replies.regenerated)

    def keywords(records: DataFrame) -> DataFrame:
        return records.join(clean.tag_keywords(records, replies.keywords).withColumnRenamed("status", "keyword_status"), "record_id")

    def split(records: DataFrame) -> DataFrame:
        return sampling.train_val(records, val_ratio, "record_id")

    first = curation(items, replies.completeness, folder)
    return Pipeline([*first.steps, ("review", review), ("control_flow", flow), ("keyword_replies", keywords), ("split", split)], folder)
