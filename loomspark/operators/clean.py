"""Cleaning of statement lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import responses, text


def removal_reason(kind: str = "item_kind", sql: str = "sql_text") -> Column:
    """Why an item is removed, or null: CJK strings first, then what isn't SQL. Objects other than param_dependent ones aren't SQL."""
    is_text = F.col(kind) == "STRING"
    return (
        F.when(F.col(kind) == "PARAM_DEPENDENT", None)
        .when(is_text & text.has_cjk(F.col(sql)), "cjk")
        .when(is_text & text.is_valid_sql(F.col(sql)), None)
        .otherwise("not_sql")
    )


def removed_items(items: DataFrame) -> DataFrame:
    """Log of what cleaning removes: record_id, item_pos, content (200 characters and an ellipsis), reason."""
    content = F.when(F.length("sql_text") > 200, F.concat(F.left("sql_text", F.lit(200)), F.lit("..."))).otherwise(F.col("sql_text"))
    return items.withColumn("reason", removal_reason()).where("reason is not null").select("record_id", "item_pos", content.alias("content"), "reason")


def clean_items(items: DataFrame) -> DataFrame:
    return items.where(removal_reason().isNull())


def clean_records(records: DataFrame, items: DataFrame) -> DataFrame:
    """record_id, list_state, statements: lists emptied by cleaning, and empty ones, become NO_SQL; sentinels stay."""
    kept = clean_items(items).groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("item_pos", "variant_pos", "sql_text"))).alias("kept"))
    met = records.select("record_id", "list_state").join(kept, "record_id", "left")
    state = F.when(F.col("list_state") == "LACK_INFO", "LACK_INFO").when(F.col("kept").isNull(), "NO_SQL").otherwise("LIST")
    return met.select("record_id", state.alias("list_state"), F.coalesce(F.transform("kept", lambda s: s["sql_text"]), F.array().cast("array<string>")).alias("statements"))


def cleaning_counters(records: DataFrame, items: DataFrame) -> DataFrame:
    """One row of totals over records and items."""
    by_record = items.withColumn("reason", removal_reason()).groupBy("record_id").agg(F.count("*").alias("n"), F.count("reason").alias("gone"), F.count_if(F.col("reason") == "cjk").alias("cjk"), F.count_if(F.col("item_kind") == "PARAM_DEPENDENT").alias("param"))
    met = records.select("record_id", "list_state").join(by_record, "record_id", "left").na.fill(0, ["n", "gone", "cjk", "param"])
    return met.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("gone") > 0).alias("modified_records"),
        F.count_if((F.col("list_state") == "EMPTY") | ((F.col("n") > 0) & (F.col("n") == F.col("gone")))).alias("emptied_records"),
        F.count_if(F.col("list_state") == "NO_SQL").alias("no_sql_records"),
        F.sum("n").alias("total_items"),
        F.sum("gone").alias("removed_items"),
        F.sum("cjk").alias("removed_cjk"),
        F.sum(F.col("n") - F.col("gone")).alias("kept_items"),
        F.sum("param").alias("param_dependent_items"),
    )


def no_sql(records: DataFrame, items: DataFrame) -> DataFrame:
    """Records whose list is the NO_SQL sentinel or holds an object of that type."""
    marked = items.where("item_kind = 'NO_SQL_GENERATE'").select("record_id").distinct().withColumn("marked", F.lit(True))
    return records.join(marked, "record_id", "left").withColumn("is_no_sql", (F.col("list_state") == "NO_SQL") | F.coalesce("marked", F.lit(False))).drop("marked")


def tag_completeness(records: DataFrame, replies: DataFrame) -> DataFrame:
    """A reply that begins with the word for no marks the list as lacking information; NO_SQL rows and missing replies stay complete."""
    reply = text.strip(F.coalesce("reply", F.lit("")))
    bad = (F.col("list_state") != "NO_SQL") & reply.startswith("否")
    reason = F.regexp_extract(reply, "^否[，,](.*)$", 1)
    return records.join(replies, "record_id", "left").select("record_id", (~bad).alias("is_complete"), F.when(bad, reason).otherwise("").alias("reason"), F.when(bad, "LACK_INFO").otherwise(F.col("list_state")).alias("list_state"))


def tag_correctness(records: DataFrame, replies: DataFrame) -> DataFrame:
    """As completeness, but a reason about transactions or table names counts as correct; LACK rows aren't judged."""
    reply = text.strip(F.coalesce("reply", F.lit("")))
    reason = F.regexp_extract(reply, "^否[，,](.*)$", 1)
    bad = ~F.col("list_state").isin("NO_SQL", "LACK_INFO") & reply.startswith("否") & ~reason.rlike("事务|表名")
    return records.join(replies, "record_id", "left").select("record_id", (~bad).alias("is_correct"), F.when(bad, reason).otherwise("").alias("reason"))


def tag_keywords(records: DataFrame, replies: DataFrame) -> DataFrame:
    """(record_id, keywords, has_keywords, status): what a reply names; a record without an answer stays, with the status ``failed``."""
    reply = text.strip(F.coalesce("reply", F.lit("")))
    failed = reply == ""
    met = records.select("record_id").join(replies.select("record_id", "reply"), "record_id", "left")
    found = F.when(failed, responses.nothing()).otherwise(responses.keywords_of(reply))
    return met.select("record_id", found.alias("keywords"), (F.size(found) > 0).alias("has_keywords"), F.when(failed, "failed").otherwise("ok").alias("status"))
