"""Records as training samples: instruction and answer, or prompt, reward and everything a rule needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts, text
from ..functions.json_text import items_at, kind, missing

# Names that readers of the samples expect.
SOURCE, ABILITY, STYLE = "code2sql_orm", "code_generation", "rule"
NONE = "array<string>"


def metadata_text(meta: Column, apart: str = " ", by: str = "\n") -> Column:
    """(code_key, code_value, code_file) as text: the key in bold, its value, and the file in parentheses; entries without key or value are left out."""
    whole = F.filter(meta, lambda m: (F.coalesce(m["code_key"], F.lit("")) != "") & (F.coalesce(m["code_value"], F.lit("")) != ""))
    file = lambda m: F.when(F.coalesce(m["code_file"], F.lit("")) != "", F.concat(F.lit(f"{apart}(文件: "), m["code_file"], F.lit(")"))).otherwise("")
    shown = F.transform(whole, lambda m: F.concat(F.lit("**"), m["code_key"], F.lit(f"**:{apart}"), m["code_value"], file(m)))
    return F.coalesce(F.array_join(shown, by), F.lit(""))


# Labels of the layout that names its parts, in order, and what stands for no metadata.
PARTS = (("code_file", "文件: "), ("lines", "行号: "), ("code_key", "键: "), ("code_value", "值: "), ("code_label", "标签: "), ("code_type", "类型: "))
NO_METADATA = "无代码元数据"


def metadata_parts(meta: Column) -> Column:
    """An array of metadata as numbered lines of named parts; a part is there if its field is, a label only if it isn't empty or 0."""

    def line(v: Column, i: Column) -> Column:
        has = lambda *fs: F.size(missing(v, *fs)) == 0
        shown = lambda f: F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit("None"))
        parts = []
        for f, label in PARTS:
            if f == "lines":
                parts.append(F.when(has("code_start_line", "code_end_line"), F.concat(F.lit(label), shown("code_start_line"), F.lit("-"), shown("code_end_line"))))
            else:
                there = has(f) & ~shown(f).isin("None", "", "0", "false") if f == "code_label" else has(f)
                parts.append(F.when(there, F.concat(F.lit(label), shown(f))))
        body = F.when(kind(v) == "OBJECT", F.array_join(F.array_compact(F.array(*parts)), " | ")).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("None")))
        return F.concat((i + 1).cast("string"), F.lit(". "), body)

    items = items_at(meta)
    return F.when(F.coalesce(F.size(items), F.lit(0)) == 0, NO_METADATA).otherwise(F.array_join(F.transform(items, line), "\n"))


def usable(extraction: DataFrame) -> DataFrame:
    """(record_id, tables, columns, notes) of which something was found and no note says that information lacks."""
    lacks = F.exists(F.coalesce("notes", F.array().cast(NONE)), lambda n: F.contains(n, F.lit(text.LACK_INFO)))
    return extraction.where((F.coalesce(F.size("tables"), F.lit(0)) + F.coalesce(F.size("columns"), F.lit(0)) > 0) & ~lacks)


def rl_samples(records: DataFrame, extraction: DataFrame, statements: DataFrame, split: str = "train") -> DataFrame:
    """(record_id, data_source, prompt, ability, reward_model, extra_info) of records with code whose names could be extracted.

    ``statements``: (record_id, statements), the ground truth; records without a row there have an empty list.
    """
    met = records.where(F.coalesce("orm_code", F.lit("")) != "").join(usable(extraction).select("record_id", "tables", "columns"), "record_id").join(statements, "record_id", "left")
    content = prompts.fill("generate", code=F.col("orm_code"), caller=F.col("caller"), metadata=metadata_text(F.col("code_meta_data")))
    truth = F.to_json(F.coalesce("statements", F.array().cast(NONE)))
    extra = F.struct(
        F.col("record_id").alias("index"), F.lit(split).alias("split"), "function_name", "source_file", "sql_pattern_cnt", "sql_types", "orm_code", "caller", "code_meta_data",
        F.array_sort("tables").alias("pre_tables"), F.array_sort("columns").alias("pre_columns"),
    )
    return met.select(
        "record_id", F.lit(SOURCE).alias("data_source"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("prompt"), F.lit(ABILITY).alias("ability"),
        F.struct(F.lit(STYLE).alias("style"), truth.alias("ground_truth")).alias("reward_model"), extra.alias("extra_info"),
    )


def caller_tasks(packs: DataFrame, needs_caller: tuple[str, ...]) -> DataFrame:
    """(name, task, scenario, caller, prompt, sql_pattern_cnt) of packs (name, scenario, code_value, orm_code, callers, metadata, sql_pattern_cnt).

    A task without a caller, but not in scenarios that need one, and a task a
    caller; packs without any code have none. The rule of a ``with_`` scenario ends the prompt.
    """
    code = F.coalesce(F.nullif("code_value", F.lit("")), F.nullif("orm_code", F.lit("")))
    alone = F.when(F.coalesce("scenario", F.lit("")).isin(*needs_caller), F.array().cast("array<struct<place:int,caller:string>>")).otherwise(F.array(F.struct(F.lit(-1).alias("place"), F.lit("").alias("caller"))))
    callers = F.transform(F.coalesce("callers", F.array().cast(NONE)), lambda c, i: F.struct(i.alias("place"), F.coalesce(c, F.lit("")).alias("caller")))
    tasks = packs.withColumn("__code", code).where("__code is not null").select("*", F.explode(F.concat(alone, callers)).alias("t")).select("*", "t.*")
    rules = F.element_at(F.create_map(*[F.lit(x) for pair in text.SCENARIO_RULES.items() for x in pair]), F.lower("scenario"))
    prompt = F.concat(prompts.fill("generate", code=F.col("__code"), caller=F.col("caller"), metadata=F.array_join(F.filter("metadata", lambda m: m != ""), "\n")), F.coalesce(F.concat(F.lit("Rule: "), rules), F.lit("")))
    name = F.when(F.col("place") < 0, F.concat("name", F.lit("_no_caller"))).otherwise(F.concat("name", F.lit("_caller_"), "place"))
    return tasks.select("name", name.alias("task"), "scenario", "caller", prompt.alias("prompt"), "sql_pattern_cnt")
