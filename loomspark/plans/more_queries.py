"""Queries of the reply parsers, validators, judges' scores, matching and inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fingerprint, responses, scenarios, text, validation
from ..operators import catalog, joining, nested, scoring
from ..sources import adapters as src
from ..sources import inputs
from ..sources import replies as said
from .queries import audit_fp, col, halves, listed, query


def joined(c, by: str = " ## "):
    return F.array_join(c, by)


# replies


@query
def parse_odd_responses(spark, sf):
    return said.replies(spark, sf, said.ODD).select("reply_id", joined(responses.parse_reply(col("reply"))).alias("statements"))


@query
def odd_keyword_responses(spark, sf):
    return said.replies(spark, sf, said.ODD).select("reply_id", joined(responses.keywords_of(col("reply")), "|").alias("keywords"))


@query
def format_responses(spark, sf):
    return said.replies(spark, sf, said.ODD).select("reply_id", joined(responses.formatted(col("reply"))).alias("statements"))


def stray_replies(spark, sf: str):
    return said.replies(spark, sf, said.nth([reply for reply, *_ in said.STRAY]))


@query
def parse_stray_responses(spark, sf):
    return stray_replies(spark, sf).select("reply_id", joined(responses.parse_reply(col("reply"))).alias("statements"))


@query
def format_stray_responses(spark, sf):
    return stray_replies(spark, sf).select("reply_id", joined(responses.formatted(col("reply"))).alias("statements"))


@query
def repair_responses(spark, sf):
    return said.replies(spark, sf, said.BROKEN).select("reply_id", joined(responses.repaired_list(col("reply"))).alias("statements"))


@query
def analysis_reports(spark, sf):
    r = said.replies(spark, sf, said.REPORT).select("reply_id", responses.analysis_report(col("reply")).alias("r"))
    return r.select("reply_id", "r.kind", "r.scenario", joined(col("r.statements")).alias("statements"))


@query
def control_flow_verdicts(spark, sf):
    return said.replies(spark, sf, said.REPORT).select("reply_id", responses.verdict(col("reply")).alias("v")).select("reply_id", "v.*")


@query
def regenerated_statements(spark, sf):
    return said.replies(spark, sf, said.REPORT).select("reply_id", joined(responses.regenerated(col("reply"))).alias("statements"))


@query
def validator_cases(spark, sf):
    r = said.replies(spark, sf, said.JUDGED)
    case = F.floor((col("reply_id") % (2 * len(said.CASES))) / 2)
    name, ok = None, None
    for i, (n, *_) in enumerate(said.CASES):
        checked = responses.validator(n)(col("reply"))
        name = F.when(case == i, n) if name is None else name.when(case == i, n)
        ok = F.when(case == i, checked) if ok is None else ok.when(case == i, checked)
    return r.groupBy(name.alias("validator"), ok.alias("ok")).agg(F.count("*").alias("n"))


@query
def validator_errors(spark, sf):
    """The first error of each kind of reply, by validator."""
    r = said.replies(spark, sf, said.nth([reply for _, reply, *_ in said.VERDICTS]))
    k = col("reply_id") % len(said.VERDICTS)
    own = {}
    for i, (name, *_) in enumerate(said.VERDICTS):
        own.setdefault(name, []).append(i)
    name, verdict = F.coalesce(*[F.when(k.isin(*ks), n) for n, ks in own.items()]), F.coalesce(*[F.when(k.isin(*ks), validation.validate(n, col("reply"))) for n, ks in own.items()])
    return r.select(k.alias("kind"), name.alias("validator"), verdict.alias("v")).groupBy("kind", "validator", "v.valid", "v.code", "v.detail").agg(F.count("*").alias("n"))


def nested_replies(spark, sf: str):
    return said.replies(spark, sf, said.nth([reply for reply, *_ in said.NESTED]))


@query
def nested_statements(spark, sf):
    r = nested_replies(spark, sf)
    return nested.gathered(nested.statements(r, ["reply_id"], "reply"), r, ["reply_id"]).select("reply_id", F.size("statements").alias("n"), joined(col("statements")).alias("statements"))


@query
def loose_statements(spark, sf):
    return nested.loose_statements(nested_replies(spark, sf), ["reply_id"], "reply").groupBy("sql_text").agg(F.count("*").alias("n"))


# clauses


def claused(spark, sf: str):
    """(stmt_id, sql_text): statements with something in every clause; a note tells users apart, and is no part of a fingerprint."""
    note = F.concat(F.expr(said.nth([q for q, *_ in said.CLAUSED])), F.lit(" -- "), col("user_id"))
    return src.table(spark, sf, "events").select(col("event_id").alias("stmt_id"), note.alias("sql_text"))


@query
def clause_features(spark, sf):
    """Fingerprints and types of statements of every clause."""
    fps = fingerprint.in_clauses(fingerprint.fingerprint(claused(spark, sf)).drop("tables", "columns"))
    return fps.groupBy((col("stmt_id") % len(said.CLAUSED)).alias("kind"), "stmt_type", "fp").agg(F.count("*").alias("n"), F.count_distinct("sql_text").alias("n_texts"))


@query
def clause_names(spark, sf):
    """How often each name stands in each clause of statements on each table."""
    return fingerprint.clause_rows(claused(spark, sf), ["stmt_id"]).groupBy("stmt_type", "clause", "table", "name").agg(F.count("*").alias("n"), F.min("stmt_id").alias("first"))


# scores of judges


def judged(spark, sf: str):
    """Replies about keywords and penalties of each labelled document."""
    d = src.table(spark, sf, "labels").select("doc_id").distinct()
    return d.select("doc_id", F.expr(JUDGE_KEYWORD).alias("keyword_reply"), F.expr(JUDGE_PENALTY).alias("penalty_reply"))


NL = said.NL
JUDGE_KEYWORD = said.choice(['x {"keyword_score": 0.7} y', '{"keyword_score": 1.5}', "none", '{"other": 1}', '{"keyword_score": "0.25"}'], "doc_id")
JUDGE_PENALTY = said.choice(['{"penalty_severity": 0.4}', f'```json{NL}{{"severity": 2}}{NL}```', 'so: {"penalty_evaluation": {"severity": 0.3}} end', "bad", '{"x": 1}', f'```{NL}{{"penalty_severity": "0.5"}}{NL}```'], "doc_id")


@query
def judge_scores(spark, sf):
    j = judged(spark, sf)
    words = F.when(col("doc_id") % 3 != 0, F.array(F.lit("save")))
    return j.select("doc_id", scoring.keyword_score(col("doc_id") % 2 == 0, words, col("keyword_reply")).alias("keyword"), scoring.severity(col("penalty_reply")).alias("severity"))


@query
def reward_v1(spark, sf):
    x = lambda m: (col("doc_id") % m) / F.lit(float(m))
    return judge_scores(spark, sf).select("doc_id", F.round(scoring.reward_v1(x(8), x(5), col("keyword"), col("severity")), 6).alias("reward"))


@query
def sample_consistency(spark, sf):
    a = audit_fp(spark, sf).where("size(tables) > 0").select("user_id", "tables", "columns")
    some = col("user_id") % 11 != 0
    none = F.array().cast("array<string>")
    e = a.select("user_id").distinct().select(
        "user_id", F.when(some, F.array(F.concat(F.lit('"USER'), col("user_id") % 5, F.lit('_items"')))).otherwise(none).alias("llm_tables"),
        F.when(some, F.array(F.lit("`ID`"), F.lit(" name"), F.lit(""))).otherwise(none).alias("llm_columns"), F.when(col("user_id") % 7 == 0, "so <LACK INFORMATION>").alias("notes"),
    )
    return scoring.sample_consistency(a, e, "user_id")


@query
def parameter_shares(spark, sf):
    found = src.table(spark, sf, "lineitem").select(col("l_orderkey").alias("sample"), F.when(col("l_partkey") % 6 != 0, F.concat(F.lit("Param_"), col("l_partkey") % 9)).alias("param"))
    known = src.table(spark, sf, "region").select(F.concat(F.lit("PARAM_"), "r_regionkey").alias("name"))
    return scoring.parameter_share(found, known, "sample", "param").select("sample", "n", "n_known", F.round("score", 6).alias("score"))


# matching and reshaping


@query
def match_samples(spark, sf):
    o = src.table(spark, sf, "orders")
    base = o.select("o_orderkey", F.expr("'f' || (o_custkey % 50)").alias("source_file"), F.when(col("o_orderkey") % 7 != 0, col("o_orderkey") % 40).alias("code_line"), F.expr("'m' || (o_orderkey % 6)").alias("function_name"), F.when(col("o_orderkey") % 4 != 0, col("o_custkey") % 300).alias("id"))
    made = o.where("o_custkey % 2 = 0").select(F.expr("'f' || (o_custkey % 70)").alias("source_file"), F.when(col("o_orderkey") % 5 != 0, col("o_orderkey") % 40).alias("code_line"), F.expr("'m' || (o_orderkey % 6)").alias("function_name"), (col("o_custkey") % 500).alias("id"), col("o_orderkey").alias("pos"))
    return joining.match_samples(base, made, ["source_file", "code_line", "function_name"], "id", "pos").select("o_orderkey", "match", "matched_by")


def tasks(spark, sf: str):
    o = src.table(spark, sf, "orders")
    scenario = F.expr("CASE (o_custkey % 200) % 4 WHEN 0 THEN 'mutual_exclusive_conditions' WHEN 1 THEN 'table_name_from_caller' WHEN 2 THEN 'condition_field_mapping' ELSE 'with_first' END")
    return o.select((col("o_custkey") % 200).alias("function"), F.when(col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("c"), col("o_orderkey") % 9)).alias("caller"), scenario.alias("scenario"), col("o_orderkey").alias("pos"))


@query
def regroup_tasks(spark, sf):
    return joining.regroup(tasks(spark, sf), "function", "caller", "scenario", "pos").select("function", "caller", "pos", "place")


@query
def route_scenarios(spark, sf):
    return tasks(spark, sf).groupBy(joining.route(col("scenario")).alias("route"), joining.is_base_scenario(col("scenario")).alias("base")).agg(F.count("*").alias("n"))


@query
def example_packs(spark, sf):
    return joining.example_packs(tasks(spark, sf), "scenario", "pos")


STAGE = {
    "precheck": "CASE o_orderkey % 5 WHEN 0 THEN 'Yes, none' WHEN 1 THEN 'no' ELSE '' END",
    "analysis": "CASE WHEN o_orderkey % 4 > 0 THEN 'SELECT a' || (o_custkey % 3) || '; DELETE b' ELSE '' END",
    "verification": "CASE WHEN o_orderkey % 7 = 0 THEN 'UPDATE v; x' ELSE '' END",
    "format": "CASE WHEN o_orderkey % 3 = 0 THEN '[\"F' || (o_custkey % 3) || ';\"]' ELSE '' END",
}


@query
def staged_analysis(spark, sf):
    o = src.table(spark, sf, "orders")
    stages = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.expr(e).alias("reply")) for n, e in STAGE.items()]))
    said_by = o.where("o_orderkey % 11 <> 0").select(col("o_orderkey").alias("record_id"), stages.alias("s")).select("record_id", "s.*")
    out = joining.staged_analysis(o.select(col("o_orderkey").alias("record_id")), said_by, responses.formatted)
    return out.select("record_id", "outcome", joined(col("statements")).alias("statements"))


@query
def case_shapes(spark, sf):
    o = src.table(spark, sf, "orders")
    parts = o.select(F.concat(F.lit("k"), "o_orderkey").alias("case_key"), F.expr("'s' || (o_orderkey % 4)").alias("scenario"), F.lit("simple").alias("complexity"), F.lit("q").alias("base_sql"), F.lit("m").alias("orm_code"), F.lit("c").alias("caller_code"), F.array(F.lit("v")).alias("variants"))
    out = None
    for i, shape in enumerate(("full", "if_else", "switch", "dynamic")):
        own = joining.cases(parts.where(col("scenario") == f"s{i}"), shape)
        own = own.select("case_key", F.lit(shape).alias("shape"), F.to_json("case").alias("case"))
        out = own if out is None else out.unionByName(own)
    return out


def scenario_table(spark):
    return spark.createDataFrame([(s, *b) for s, b in scenarios.SCENARIO_VARIANTS.items()], "scenario string, least int, most int")


NAMES = tuple(scenarios.SCENARIO_VARIANTS)
#: The scenario of an order; the last three have no case.
CASE_SCENARIO = "CASE o_orderkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES[:8])) + " END"


@query
def scenario_success(spark, sf):
    o = src.table(spark, sf, "orders").select(F.expr(CASE_SCENARIO).alias("scenario"), ((col("o_orderkey") % 8 > 2) & (col("o_custkey") % 5 > 0)).alias("valid"))
    return joining.success_table(o, scenario_table(spark).select("scenario"))


@query
def variant_bounds(spark, sf):
    levels = spark.createDataFrame([(k, *b) for k, b in scenarios.LEVEL_VARIANTS.items()], "level string, level_least int, level_most int")
    met = scenario_table(spark).crossJoin(F.broadcast(levels))  # 11 rows by 3
    b = joining.variant_bounds(col("least"), col("most"), col("level_least"), col("level_most"))
    return met.select("scenario", "level", b.alias("b")).select("scenario", "level", "b.least", "b.most")


# reports, samples, inputs


@query
def report_precision(spark, sf):
    cat, corpus = halves(spark, sf)
    m = catalog.match(corpus.select("stmt_id", "fp"), cat)
    out = m.agg(F.count_if(~text.is_excluded(col("fp")) & col("in_catalog")).alias("matched"), F.count_if(~text.is_excluded(col("fp")) & ~col("in_catalog")).alias("unmatched"), F.count_if(text.is_excluded(col("fp"))).alias("excluded"))
    return out.withColumn("valid", col("matched") + col("unmatched")).withColumn("precision", scoring.half_even(F.try_divide(col("matched").cast("double"), col("valid")), 4))


@query
def combined_report(spark, sf):
    """All parts of the data report as (section, metric, value)."""
    r = listed(spark, sf)
    basic = r.agg(F.count("*").cast("double").alias("total"), F.count_if(col("n_items") > 0).cast("double").alias("with_sql"), F.round(F.avg("n_items"), 6).alias("mean_items"))
    code = r.agg(F.round(F.avg(F.length("orm_code")), 6).alias("mean_length"), F.count_if(col("caller") != "").cast("double").alias("with_caller"))
    quality = r.agg(F.round(100 * F.avg((col("orm_code") != "").cast("double")), 6).alias("orm_code"))
    rows = [d.select(F.lit(n).alias("section"), F.explode(F.map_from_arrays(F.array(*map(F.lit, d.columns)), F.array(*d.columns))).alias("metric", "value")) for n, d in (("basic", basic), ("code", code), ("quality", quality))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def rl_ground_truth(spark, sf):
    """The statements that a reward compares with, as a JSON list; an empty list for records without any."""
    items = src.items(spark, sf).where("item_kind = 'STRING' and sql_text <> ''").groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("item_pos", "sql_text"))).alias("l"))
    met = src.records(spark, sf).select("record_id").join(items, "record_id", "left")
    return met.select("record_id", F.to_json(F.coalesce(F.transform("l", lambda s: s["sql_text"]), F.array().cast("array<string>"))).alias("ground_truth"))


@query
def dataset_card(spark, sf):
    split = src.records(spark, sf).select((col("record_id") % 10 == 0).alias("val"))
    return split.agg(F.lit("orm_to_sql").alias("dataset_name"), F.count_if(~col("val")).alias("train"), F.count_if("val").alias("val"), F.count("*").alias("total"), F.lit("rule").alias("reward_model_style"))


@query
def validation_export(spark, sf):
    cut = F.when(F.length("orm_code") > 50, F.concat(F.left("orm_code", F.lit(50)), F.lit("..."))).otherwise(col("orm_code"))
    return src.records(spark, sf).where("orm_code <> ''").select("record_id", cut.alias("orm_code"), "caller", "list_state")


@query
def cleaning_sample(spark, sf):
    """The first five lines of the cleaning log."""
    from ..operators import clean

    return clean.removed_items(src.items(spark, sf)).orderBy("record_id", "item_pos", "reason", "content").limit(5)


@query
def empty_validation(spark, sf):
    """Totals of a validation without candidates: one row of zeros."""
    return src.records(spark, sf).where("record_id < 0").agg(F.count("*").alias("candidates"), F.count_if(col("orm_code") == "x").alias("confirmed"), F.coalesce(F.try_divide(F.count_if(col("orm_code") == "x").cast("double"), F.count("*")), F.lit(0.0)).alias("rate"))


@query
def generation_validity(spark, sf):
    ok = responses.validator("regeneration")(col("reply"))
    r = src.replies(spark, sf).agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))
    return r.withColumn("rate", F.round(F.coalesce(F.try_divide(col("valid").cast("double"), col("valid") + col("invalid")), F.lit(0.0)), 6))


PATH = "'base/' || CASE event_id % 5 WHEN 0 THEN 'workflow_2024_x' WHEN 1 THEN 'run1' WHEN 2 THEN 'core/run2' ELSE 'workflow_ab' END || CASE user_id % 3 WHEN 0 THEN '/sql_generation/' ELSE '/other/' END || 'f' || event_id || CASE event_id % 4 WHEN 0 THEN '.txt' ELSE '.json' END"


@query
def generation_files(spark, sf):
    paths = src.table(spark, sf, "events").select(F.expr(PATH).alias("path"))
    return paths.where(inputs.is_generation_file(col("path"))).select("path", inputs.is_privileged(col("path"), "core").alias("privileged"))


RUN = {
    "run": "'run' || (event_id % 40)",
    "kind": "CASE event_id % 2 WHEN 0 THEN 'workflow' ELSE 'report' END",
    "finished": "ts",
    "path": "'out/' || CASE event_id % 6 WHEN 0 THEN 'final_data' WHEN 1 THEN 'step_log' WHEN 2 THEN 'x_statistics' WHEN 3 THEN 'cleaned' ELSE 'part' END || event_id || '.json'",
    "bytes": "user_id * 1000 + event_id % 1000",
}


def runs(spark, sf: str):
    return src.table(spark, sf, "events").select(*[F.expr(e).alias(n) for n, e in RUN.items()])


@query
def latest_run(spark, sf):
    return inputs.latest_run(runs(spark, sf), "workflow").select("run")


@query
def latest_data_files(spark, sf):
    return inputs.latest_data(runs(spark, sf), [r"^final_", r"^cleaned"])


INPUT = """CASE o_orderkey % 3 WHEN 0 THEN '{"s' || o_orderkey || '": {"scenario": "x", "code_key": "k' || o_custkey || '", "code_value": "v", "callers": [{}, {}]}}'
 WHEN 1 THEN '{"f1": {"orm_code": "o' || o_custkey || '"}, "f2": {"code_value": "w", "callers": [{}]}}' ELSE '[{"function_name": "g' || o_orderkey || '", "code_value": "z"}]' END"""


@query
def generation_inputs(spark, sf):
    files = src.table(spark, sf, "orders").select(F.expr(INPUT).alias("content"))
    return inputs.generation_inputs(files)


# parts of reports


@query
def table_mentions(spark, sf):
    up = F.upper("sql_text")
    found = lambda word: F.transform(F.regexp_extract_all(up, F.lit(rf"{word}\s+(\w+)"), F.lit(1)), lambda t: F.struct(F.lit(word).alias("clause"), t.alias("table")))
    items = src.items(spark, sf).where("item_kind = 'STRING'")
    return items.select(F.explode(F.concat(found("FROM"), found("JOIN"))).alias("x")).select("x.*").groupBy("clause", "table").agg(F.count("*").alias("n"))


@query
def reanalysis_merge(spark, sf):
    """Records without SQL get the statements of a second analysis, and stay as they are where it finds none."""
    replies = src.replies(spark, sf).select(col("reply_id").alias("record_id"), responses.parse_reply(col("reply")).alias("found"))
    met = src.records(spark, sf).select("record_id", "list_state").join(replies, "record_id", "left")
    new = (col("list_state") == "NO_SQL") & (F.coalesce(F.size("found"), F.lit(0)) > 0)
    return met.select("record_id", F.when(new, "LIST").otherwise(col("list_state")).alias("list_state"), F.when(new, joined(col("found"))).alias("statements"))


@query
def known_sql_types(spark, sf):
    types = listed(spark, sf).select(F.explode("sql_types").alias("sql_type"))
    return types.where(col("sql_type").isin(*[w for w, _ in text.DML])).groupBy("sql_type").agg(F.count("*").alias("n"))


@query
def unmatched_by_type(spark, sf):
    cat, corpus = halves(spark, sf)
    m = catalog.match(corpus.select("stmt_id", "fp", "sql_text"), cat).where("not in_catalog")
    return m.groupBy(text.sql_type_with_transactions(col("sql_text")).alias("sql_type")).agg(F.count("*").alias("n"))


def judged_samples(spark, sf: str):
    """A sample per user: how many statements are valid and matched, and its class; every tenth sample's inference failed."""
    cat, corpus = halves(spark, sf)
    m = catalog.match(corpus.select("user_id", "stmt_id", "fp"), cat)
    valid = ~text.is_excluded(col("fp"))
    s = m.groupBy("user_id").agg(F.count_if(valid).alias("valid"), F.count_if(valid & col("in_catalog")).alias("matched"))
    kind = F.when(col("user_id") % 10 == 3, "failed").when(col("matched") > 0, "excellent").when(col("valid") > 0, "good").otherwise("poor")
    return s.withColumn("kind", kind)


@query
def sample_classes(spark, sf):
    return judged_samples(spark, sf).groupBy("kind").agg(F.count("*").alias("n"), F.sum("valid").alias("valid"), F.sum("matched").alias("matched"))


@query
def first_examples(spark, sf):
    """The first three samples of each class."""
    s = judged_samples(spark, sf)
    first = [s.where(col("kind") == k).orderBy("user_id").limit(3) for k in ("failed", "excellent", "good", "poor")]
    out = first[0]
    for f in first[1:]:
        out = out.unionByName(f)
    return out.select("kind", "user_id")


JUDGE_BRANCH = said.choice(['{"score": 0.5}', '{"score": 0, "final_evaluation": {"score": 0.8}}', '{"evaluation": {"score": 3}}', "x", '{"score": 0}', 'so {"score": "0.25"} end'], "doc_id")


@query
def branch_replies(spark, sf):
    d = src.table(spark, sf, "labels").select("doc_id").distinct()
    return d.select("doc_id", scoring.branch_reply(F.expr(JUDGE_BRANCH)).alias("score"))


@query
def label_counters(spark, sf):
    from .queries import condition_labels

    labels = condition_labels(spark, sf).withColumn("labels", F.split("condition", r"\|"))
    mapped, has = col("record_id") % 2 == 1, lambda n: F.array_contains("labels", n)
    return labels.agg(
        F.count("*").alias("total_records"), F.count_if(mapped).alias("condition_mapping_records"), F.count_if(~mapped).alias("other_records"),
        F.count_if(~mapped & has("if-else")).alias("if_else_removed"), F.count_if(mapped & has("if-else")).alias("if_else_kept"), F.count_if(has("keyword")).alias("keyword_kept"),
    )


@query
def variant_equivalence(spark, sf):
    o = src.table(spark, sf, "orders")
    kind = lambda k: F.when(col("o_orderkey") % k == 0, "LACK_INFORMATION").otherwise("param_dependent")
    one = F.array(F.concat(F.lit("SELECT  a"), col("o_custkey") % 4, F.lit(";")), F.lit("x"))
    two = F.when(col("o_orderkey") % 3 == 0, F.array(F.concat(F.lit("select A"), col("o_orderkey") % 4))).otherwise(F.array(F.concat(F.lit("select A"), col("o_orderkey") % 4), F.lit("y ")))
    return o.groupBy(text.same_variants(kind(5), one, kind(10), two).alias("same")).agg(F.count("*").alias("n"))
