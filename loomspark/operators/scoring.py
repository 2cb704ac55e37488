"""Reward kernels: arithmetic over score columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import kind, let, whole_json


def clamp(c: Column) -> Column:
    """Between 0 and 1; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)))


def half_even(c: Column, digits: int) -> Column:
    """Rounds half to even; at six decimals first, so that float noise decides no tie."""
    return F.bround(F.round(c, 6), digits)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def plain_names(names: Column) -> Column:
    """Distinct names, lower-cased, without quotes and white space around; empty and null ones go."""
    kept = F.filter(names, lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.transform(kept, lambda x: F.regexp_replace(F.lower(F.regexp_replace(x, "[\"`']", "")), r"^\s+|\s+$", "")))


def consistency(tables: Column, other_tables: Column, columns: Column, other_columns: Column, table_weight: float = 0.6, column_weight: float = 0.4) -> Column:
    """Weighted Jaccard similarity of table and column names, two decimals."""
    whole = table_weight * jaccard(plain_names(tables), plain_names(other_tables)) + column_weight * jaccard(plain_names(columns), plain_names(other_columns))
    return clamp(half_even(whole, 2))


def validity(fingerprinted: DataFrame, sample: str) -> DataFrame:
    """Share of a sample's statements that can be read, two decimals."""
    return fingerprinted.groupBy(sample).agg(half_even(F.avg((F.col("fp") != "invalid_sql").cast("double")), 2).alias("validity"))


def reward_v2(validity: Column, consistency: Column, keyword: Column, severity: Column, cap: float = 0.3) -> Column:
    """0.3, 0.2, 0.5; without a keyword score the first two share all weight; less the capped penalty."""
    base = F.when(keyword.isNull(), (0.3 * validity + 0.2 * consistency) / 0.5).otherwise(0.3 * validity + 0.2 * consistency + 0.5 * clamp(keyword))
    return half_even(clamp(base - cap * clamp(severity)), 2)


def reward_by(settings, validity: Column, consistency: Column, keyword: Column, severity: Column) -> Column:
    """``reward_v2`` with the weights and the cap of a run's settings (``plans.config.Settings``); without a keyword score the other weights share all of it."""
    r = settings.rewards
    two = r.validity * validity + r.consistency * consistency
    base = F.when(keyword.isNull(), two / (r.validity + r.consistency)).otherwise(two + r.keyword * clamp(keyword))
    return half_even(clamp(base - r.penalty_cap * clamp(severity)), 2)


def reward_five(validity: Column, consistency: Column, keyword: Column, branch: Column, severity: Column, cap: float = 0.2) -> Column:
    """0.25, 0.20, 0.15, 0.20; without a keyword score the other three share all weight, with one nothing is shared out. Less the capped penalty."""
    others = 0.25 * validity + 0.20 * consistency + 0.20 * branch
    base = F.when(keyword.isNull(), others / 0.65).otherwise(others + 0.15 * F.coalesce(keyword, F.lit(0.0)))
    return clamp(half_even(F.greatest(base - cap * severity, F.lit(0.0)), 2))


def reward_v1(validity: Column, consistency: Column, keyword: Column, severity: Column, cap: float = 0.3) -> Column:
    """0.6, 0.4 and 0.1 of a keyword score, two decimals; the penalty goes off after that, down to 0."""
    base = 0.6 * validity + 0.4 * consistency
    whole = half_even(clamp(F.when(keyword.isNull(), base).otherwise(base + 0.1 * F.coalesce(keyword, F.lit(0.0)))), 2)
    return F.greatest(whole - cap * severity, F.lit(0.0))


def sample_consistency(statements: DataFrame, extracted: DataFrame, sample: str) -> DataFrame:
    """statements (sample, tables, columns), extracted (sample, llm_tables, llm_columns, notes) -> (sample, n, score).

    The mean over a sample's statements, two decimals; a sample whose
    extraction is empty or says that information lacks has no statements that
    count, and scores 0.
    """
    met = statements.join(extracted, sample)
    counts = ~F.coalesce(F.contains("notes", F.lit("<LACK INFORMATION>")), F.lit(False)) & (F.size("llm_tables") + F.size("llm_columns") > 0)
    score = F.when(counts, consistency(F.col("llm_tables"), F.col("tables"), F.col("llm_columns"), F.col("columns")))
    return met.groupBy(sample).agg(F.count(score).alias("n"), F.coalesce(half_even(F.avg(score), 2), F.lit(0.0)).alias("score"))


def branch_score(score: Column, final: Column, evaluation: Column) -> Column:
    """First of the three that is neither null nor zero, clamped; else 0."""
    return clamp(F.coalesce(F.nullif(score, F.lit(0.0)), F.nullif(final, F.lit(0.0)), F.nullif(evaluation, F.lit(0.0)), F.lit(0.0)))


def instruction(syntax: Column, params: Column, tolerable: Column, significant: Column) -> Column:
    """0.6 syntax, 0.4 parameters, less 0.1 a tolerable and 0.3 a significant risk; two decimals."""
    return half_even(clamp(0.6 * syntax + 0.4 * params - 0.1 * tolerable - 0.3 * significant), 2)


def composite(expect: Column, steps: Column, syntax: Column, params: Column, tolerable: Column, significant: Column) -> Column:
    """0.3 expectation, 0.3 key steps, 0.4 of the rounded instruction score; two decimals."""
    return clamp(half_even(0.30 * expect + 0.30 * steps + 0.40 * instruction(syntax, params, tolerable, significant), 2))


def json_in(reply: Column) -> Column:
    """The JSON value between the first brace and the last one, as a variant; null if there is none."""
    return whole_json(F.nullif(F.regexp_extract(reply, r"(?s)(\{.*\})", 1), F.lit("")))


def keyword_score(has_keywords: Column, keywords: Column, reply: Column) -> Column:
    """Null for samples without special keywords, else the reply's clamped ``keyword_score``; 0 where it has none."""
    asked = F.coalesce(has_keywords, F.lit(False)) & (F.coalesce(F.size(keywords), F.lit(0)) > 0)
    return F.when(asked, F.coalesce(clamp(F.try_variant_get(json_in(reply), "$.keyword_score", "double")), F.lit(0.0)))


def severity(reply: Column) -> Column:
    """The clamped penalty severity of a judge's reply; 0 where none can be read.

    The first of the two fields that holds a number, a truth value or a text decides, at the top or
    inside ``penalty_evaluation``, whether or not it can be read.
    """
    # Fences, and the fields in their order.
    whole = whole_json(reply)
    fence = whole_json(F.nullif(F.regexp_extract(reply, "(?is)```json\\s*(.+?)\\s*```", 1), F.lit("")))
    bare = whole_json(F.nullif(F.regexp_replace(F.regexp_extract(reply, "(?s)(```.*?```)", 1), "```[a-zA-Z0-9_]*|`+$", ""), F.lit("")))
    paths = [f"$.{'penalty_evaluation.' * depth}{name}" for depth in range(3) for name in ("penalty_severity", "severity")]

    def found(v: Column) -> Column:
        readable = lambda p: kind(v, p).isin("STRING", "BOOLEAN", "BIGINT", "DOUBLE", "DECIMAL")
        number = lambda p: F.when(kind(v, p) == "BOOLEAN", F.try_variant_get(v, p, "boolean").cast("double")).otherwise(F.try_variant_get(v, p, "double"))
        return F.coalesce(*[F.when(readable(p), F.struct(number(p).alias("x"))) for p in paths])["x"]

    return F.coalesce(clamp(let(F.coalesce(whole, fence, bare, json_in(reply)), found)), F.lit(0.0))


def evaluation_log(samples: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Samples (solution, truth, expected, expect, steps, instruction, final) as log rows: a short hash of both texts, scores of three decimals, the weights.

    Where nothing was expected, expectation counts as met.
    """
    weights = weights or {"expect": 0.30, "steps": 0.30, "instruction": 0.40}
    met = samples.withColumn("expect", F.when(F.trim(F.coalesce("expected", F.lit(""))) == "", F.lit(1.0)).otherwise(F.col("expect")))
    scores = F.struct(*[half_even(F.col(c), 3).alias(c) for c in ("expect", "steps", "instruction", "final")])
    short = F.left(F.md5(F.concat(F.coalesce("solution", F.lit("")), F.coalesce("truth", F.lit("")))), F.lit(8))
    return met.select("*", short.alias("content_hash"), scores.alias("scores"), F.struct(*[F.lit(v).alias(k) for k, v in weights.items()]).alias("weights"))


def parameter_share(found: DataFrame, known: DataFrame, sample: str, param: str) -> DataFrame:
    """(sample, n, n_known, score): the share of a sample's parameters on a list of known ones, in any case. Samples without parameters score 1."""
    listed = known.select(F.lower(F.col(known.columns[0])).alias("__known")).distinct().withColumn("__hit", F.lit(1))
    met = found.withColumn("__known", F.lower(param)).join(listed, "__known", "left")
    counts = met.groupBy(sample).agg(F.count(param).alias("n"), F.count("__hit").alias("n_known"))
    return counts.withColumn("score", F.coalesce(F.try_divide("n_known", "n"), F.lit(1.0)))


def band(score: Column) -> Column:
    return F.when(score >= 0.8, "0.8-1.0").when(score >= 0.6, "0.6-0.8").when(score >= 0.4, "0.4-0.6").otherwise("0.0-0.4")


def branch_reply(reply: Column) -> Column:
    """The branch score of a judge's reply: the first of its three places that isn't 0; 0 where none can be read."""
    v = json_in(reply)
    return branch_score(*[F.try_variant_get(v, p, "double") for p in ("$.score", "$.final_evaluation.score", "$.evaluation.score")])
