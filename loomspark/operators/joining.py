"""Matching, merging and reshaping record-shaped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Scenarios in which a method needs a caller.
NEEDS_CALLER = ("mutual_exclusive_conditions", "table_name_from_caller")


def first_of(df: DataFrame, keys: list[str], order: str, value: str, alias: str) -> DataFrame:
    """(keys, alias): the value of each key's first row, without a sort."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(alias))


def counts_as_id(df: DataFrame, ident: str) -> Column:
    """Identifiers that are missing, 0 or empty match nothing."""
    c = F.col(ident)
    return c.isNotNull() & (c != F.lit("") if isinstance(df.schema[ident].dataType, StringType) else c != F.lit(0))


def match_samples(baseline: DataFrame, generated: DataFrame, triple: list[str], ident: str, order: str) -> DataFrame:
    """``baseline`` with ``match``: the order number of the first generated row of the same triple, else of the same identifier, if it has one; null without a match. Null parts of a triple match null ones."""
    marked = lambda d: d.withColumn("__key", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in triple]))
    by_triple = marked(generated).groupBy("__key", *triple).agg(F.min(order).alias("__one"))
    right = by_triple.select("__key", "__one", *[F.col(c).alias(f"__{c}") for c in triple])
    same = F.lit(True)
    for c in triple:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    met = marked(baseline).alias("b").join(right.alias("r"), (F.col("b.__key") == F.col("r.__key")) & same, "left")
    met = met.select("b.*", "__one").drop("__key")
    by_id = generated.where(counts_as_id(generated, ident)).groupBy(F.col(ident).alias("__id")).agg(F.min(order).alias("__two"))
    met = met.join(by_id, F.col(ident) == F.col("__id"), "left")
    return met.withColumn("match", F.coalesce("__one", "__two")).withColumn("matched_by", F.when(F.col("__one").isNotNull(), "triple").when(F.col("__two").isNotNull(), "id")).drop("__one", "__two", "__id")


def regroup(tasks: DataFrame, function: str, caller: str, scenario: str, order: str) -> DataFrame:
    """Adds ``place`` inside each function: the row without caller first (the last such task counts; none in scenarios that need a caller), then callers in order."""
    bare = F.col(caller) == ""
    last = tasks.where(bare).groupBy(function).agg(F.max(order).alias("__last"))
    met = tasks.join(last, function, "left").where(~bare | ((F.col(order) == F.col("__last")) & ~F.col(scenario).isin(*NEEDS_CALLER)))
    place = F.row_number().over(Window.partitionBy(function).orderBy(F.when(bare, 0).otherwise(1), order))
    return met.withColumn("place", place).drop("__last")


def route(scenario: Column) -> Column:
    """The kind of prompt that a method's scenario asks for."""
    return F.when(scenario.isin(*NEEDS_CALLER, "condition_field_mapping"), scenario).otherwise("standard")


def is_base_scenario(scenario: Column) -> Column:
    """All but the scenarios that judge first and generate then."""
    return ~scenario.startswith("with_")


def example_packs(packs: DataFrame, scenario: str, order: str) -> DataFrame:
    """(scenario, example): the first pack of each scenario."""
    return first_of(packs, [scenario], order, order, "example")


def staged_analysis(records: DataFrame, replies: DataFrame, parse) -> DataFrame:
    """records (record_id), replies (record_id, stage, reply) -> (record_id, outcome, statements).

    A precheck that says yes means that the method emits no SQL, and the other
    stages are left out. Otherwise the formatting reply is parsed, else that of
    the verification, else the analysis.
    """
    stages = replies.groupBy("record_id").pivot("stage", ["precheck", "analysis", "verification", "format"]).agg(F.first("reply"))
    met = records.join(stages, "record_id", "left")
    skipped = F.coalesce(F.lower("precheck").contains("yes"), F.lit(False))
    best = F.coalesce(F.nullif("format", F.lit("")), F.nullif("verification", F.lit("")), F.nullif("analysis", F.lit("")))
    outcome = F.when(skipped, "no_sql").when(best.isNull(), "failed").otherwise("analysed")
    return met.select("record_id", outcome.alias("outcome"), F.when(outcome == "analysed", parse(best)).alias("statements"))


def cases(parts: DataFrame, shape: str) -> DataFrame:
    """(scenario, complexity, base_sql, orm_code, caller_code, variants) as case structs of one of four shapes: full, if_else, switch, dynamic."""
    names = {"full": "control_flow_sqls", "if_else": "if_else_sqls", "switch": "switch_sqls", "dynamic": "dynamic_sqls"}
    fields = ["scenario", *(["complexity"] if shape == "full" else []), "base_sql", "orm_code", "caller_code"]
    return parts.select("case_key", F.struct(*fields, F.col("variants").alias(names[shape]), F.struct(F.lit("1.0").alias("version")).alias("metadata")).alias("case"))


def success_table(cases_found: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(scenario, total, valid, rate, low) of every scenario, those without cases too; ``low``: some cases, under half of them valid."""
    stats = cases_found.groupBy("scenario").agg(F.count("*").alias("total"), F.count_if("valid").alias("valid"))
    met = scenarios.join(stats, "scenario", "left").na.fill(0, ["total", "valid"])
    share = F.coalesce(F.try_divide(F.col("valid"), F.col("total")), F.lit(0.0))
    return met.select("scenario", "total", "valid", F.round(100 * share, 1).alias("rate"), ((F.col("total") > 0) & (share < 0.5)).alias("low"))


def variant_bounds(scenario_min: Column, scenario_max: Column, level_min: Column, level_max: Column) -> Column:
    """Struct (least, most) of a case's variants: the narrower of both bounds, the scenario's own where they contradict each other."""
    least, most = F.greatest(scenario_min, level_min), F.least(scenario_max, level_max)
    clash = least > most
    return F.struct(F.when(clash, scenario_min).otherwise(least).alias("least"), F.when(clash, scenario_max).otherwise(most).alias("most"))


def picked(words: list[str], key: Column, seed: int = 42) -> Column:
    """One of the words, by the key's hash."""
    return F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(len(words))) + 1).cast("int"))


def with_metadata(df: DataFrame, **facts) -> DataFrame:
    """One row: the facts, the number of rows, and when it was made."""
    return df.agg(F.count("*").alias("n")).select("n", *[F.lit(v).alias(k) for k, v in facts.items()], F.current_timestamp().alias("made_at"))


def back_off(attempt: Column, delay: float, exponential: bool = False, most: float = 60.0, jitter: Column | None = None) -> Column:
    """Seconds before the next attempt: delay * (attempt + 1), or delay * 2^attempt, at most ``most``, plus a share of itself."""
    wait = F.least(F.lit(delay) * F.pow(F.lit(2.0), attempt), F.lit(most)) if exponential else F.lit(delay) * (attempt + 1)
    return wait * (1 + jitter) if jitter is not None else wait
