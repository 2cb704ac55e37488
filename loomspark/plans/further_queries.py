"""Queries of evaluation runs, reports of many sections, folders, and lists in their raw form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import prompts, rawlists, responses, scenarios, text
from ..functions.fingerprint import fingerprint
from ..operators import convert, evaluation, joining, lists, reports, reviews, sampling, scoring
from ..sources import adapters as src
from ..sources import folders, results
from ..sources import lists as raw
from ..sources import records as files
from ..sources import replies as said
from ..streaming import reward_log
from .queries import audit_fp, col, listed, query
from .staging import shared_folder, stage

# evaluation runs


def evaluated_rows(spark, sf: str):
    """(samples, judged statements, catalog): the statements are written once, as several counters read them."""
    rows = evaluation.latest_rows(results.rows(spark, sf))
    known = stage(fingerprint(results.known(spark, sf)).select("seen", "sql_text", "fp"), "catalog")
    return rows, stage(evaluation.judged(evaluation.statements(rows), known), "judged"), known


@query
def evaluation_summary(spark, sf):
    """A run's statistics in one row."""
    return evaluation.summary(*evaluated_rows(spark, sf))


@query
def evaluation_units(spark, sf):
    """The units of each sample, nested."""
    _, found, _ = evaluated_rows(spark, sf)
    shown = F.transform("units", lambda u: F.concat_ws(":", F.array_join(u["place"], "/"), u["unit"]))
    return evaluation.per_sample(evaluation.unit_kinds(found)).select("sample_id", F.array_join(shown, " ").alias("units"))


@query
def evaluation_exclusions(spark, sf):
    return evaluation.exclusions(evaluated_rows(spark, sf)[1])


@query
def evaluation_coverage(spark, sf):
    """Adjusted and combined rates, with the catalog's tables in the second place."""
    _, found, known = evaluated_rows(spark, sf)
    return evaluation.coverage_report(evaluation.unit_kinds(found), known)


@query
def evaluation_lists(spark, sf):
    """Sizes of the lists that a run writes out."""
    _, found, known = evaluated_rows(spark, sf)
    return evaluation.match_lists(found, evaluation.unit_kinds(found), known).groupBy("list", "sql_text", "reason").agg(F.count("*").alias("n"))


# reports


@query
def data_report(spark, sf):
    """All sections of the data report from one pass over the records."""
    texts = src.items(spark, sf).where("item_kind = 'STRING' and sql_text <> ''").groupBy("record_id").agg(F.collect_list("sql_text").alias("texts"))
    r = listed(spark, sf).join(texts, "record_id", "left").withColumn("texts", F.coalesce("texts", F.array().cast("array<string>")))
    return reports.data_report(r)


def samples(spark, sf: str):
    """A sample per user: its statements, fingerprints and what the catalog has of them; every tenth sample's inference failed."""
    fps = stage(audit_fp(spark, sf).select("user_id", "stmt_id", "sql_text", "fp"), "audit")
    known = fps.where("stmt_id % 2 = 0").select("fp").distinct().withColumn("hit", F.lit(True))
    met = fps.where("stmt_id % 2 = 1").join(known, "fp", "left")
    valid = ~text.is_excluded(col("fp"))
    one = F.struct("stmt_id", "fp", (valid & col("hit").isNotNull()).alias("matched"), "sql_text")
    found = met.groupBy(col("user_id").alias("sample_id")).agg(F.array_sort(F.collect_list(one)).alias("fps"), F.count_if(valid).alias("valid"), F.count_if(valid & col("hit").isNotNull()).alias("matched"))
    error = F.when(col("sample_id") % 4 == 0, F.concat(F.lit("bad "), F.when(col("sample_id") % 8 == 0, "JSON").otherwise("timeout")))
    return found.withColumn("ok", col("sample_id") % 10 != 3).withColumn("statements", F.transform("fps", lambda x: x["sql_text"])).withColumn("error", error)


@query
def pattern_analysis(spark, sf):
    return reports.pattern_report(samples(spark, sf), 6)


@query
def evaluation_report(spark, sf):
    """Patterns, coverage, quality and examples of an evaluation, in long form."""
    return reports.evaluation_report(samples(spark, sf), 3, 4)


# parsers and scores


def told(spark, sf: str, cases: list[tuple]):
    return said.replies(spark, sf, said.nth([reply for reply, *_ in cases]))


@query
def simple_responses(spark, sf):
    return told(spark, sf, said.SIMPLE).select("reply_id", F.array_join(responses.sql_response(col("reply")), " ## ").alias("statements"))


@query
def prose_statements(spark, sf):
    return told(spark, sf, said.PROSE).select("reply_id", F.array_join(responses.extracted_statements(col("reply")), " ## ").alias("statements"))


@query
def penalty_severities(spark, sf):
    return told(spark, sf, said.SEVERITIES).select("reply_id", scoring.severity(col("reply")).alias("severity"))


@query
def evaluation_log(spark, sf):
    """Scores of the composite reward with their log's hash and weights."""
    x = lambda m: (col("doc_id") % m) / F.lit(float(m))
    d = src.table(spark, sf, "labels").select("doc_id").distinct().select(
        "doc_id", F.concat(F.lit("s"), "doc_id").alias("solution"), F.when(col("doc_id") % 2 == 0, F.concat(F.lit("t"), "doc_id")).alias("truth"), F.when(col("doc_id") % 3 == 0, " ").otherwise("x").alias("expected"),
        x(7).alias("expect"), x(16).alias("steps"), x(5).alias("instruction"), x(9).alias("final"),
    )
    return scoring.evaluation_log(d).select("doc_id", "content_hash", "scores.*", F.col("weights.expect").alias("expect_weight"))


# raw lists


@query
def fix_raw_lists(spark, sf):
    rows, gone, more = raw.records(spark, sf)
    return lists.fix_lists(rows, gone, more, ["orm_code", "caller"]).select("record_id", "statement_list", "touched")


@query
def no_sql_forms(spark, sf):
    f = raw.of(spark, sf, [t for t, _ in raw.SENTINELS]).select(lists.no_sql_forms(col("statement_list")).alias("f")).select("f.*")
    return f.agg(*[F.count_if(n).alias(n) for n in ("one", "two", "three")], F.count("*").alias("records"))


@query
def incomplete_statements(spark, sf):
    return raw.of(spark, sf, [t for t, _ in raw.GAPS]).select("record_id", lists.marked_list(col("statement_list")).alias("statement_list"))


@query
def list_patterns(spark, sf):
    return lists.patterns(raw.of(spark, sf, [t for t, _ in raw.PATTERNS]))


@query
def variant_lines(spark, sf):
    return raw.of(spark, sf, [t for t, _ in raw.LINES]).select("record_id", lists.variant_lines(col("statement_list")).alias("lines"))


@query
def pruned_examples(spark, sf):
    return raw.of(spark, sf, [t for t, _ in raw.EXAMPLES]).select("record_id", rawlists.pruned_json("statement_list").alias("example"))


# samples and tasks


META = "array<struct<code_key:string,code_value:string,code_file:string>>"


@query
def rl_records(spark, sf):
    """Whole samples of the reward trainer, with prompt and ground truth."""
    names = stage(fingerprint(src.items(spark, sf).where("sql_text <> ''")).select("record_id", "item_pos", "variant_pos", "item_kind", "sql_text", "tables", "columns"), "items")
    both = names.groupBy("record_id").agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("tables", "columns")])
    extraction = both.withColumn("notes", F.when(col("record_id") % 13 == 0, F.array(F.lit("so <LACK INFORMATION>"))))
    truth = names.where("item_kind = 'STRING'").groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", "variant_pos", "sql_text"))), lambda s: s["sql_text"]).alias("statements"))
    meta = F.array(F.struct(F.lit("U").alias("code_key"), col("code_value").alias("code_value"), F.when(col("record_id") % 2 == 0, "u.go").alias("code_file")), F.struct(F.lit("").alias("code_key"), F.lit("x").alias("code_value"), F.lit("y").alias("code_file")))
    r = src.records(spark, sf).withColumn("code_meta_data", meta).withColumn("sql_types", F.array(F.lit("SELECT"))).withColumn("sql_pattern_cnt", col("pattern_cnt"))
    s = convert.rl_samples(r, extraction, truth)
    return s.select("record_id", "data_source", "ability", col("prompt")[0]["role"].alias("role"), col("prompt")[0]["content"].alias("content"), "reward_model.style", "reward_model.ground_truth", "extra_info.split", F.array_join("extra_info.pre_tables", ",").alias("pre_tables"), F.array_join("extra_info.pre_columns", ",").alias("pre_columns"), "extra_info.source_file")


SCENARIO = "CASE o_orderkey % 5 WHEN 0 THEN 'mutual_exclusive_conditions' WHEN 1 THEN 'table_name_from_caller' WHEN 2 THEN 'With_First' WHEN 3 THEN 'plain' END"


@query
def caller_tasks(spark, sf):
    o = src.table(spark, sf, "orders")
    packs = o.select(
        F.concat(F.lit("f"), "o_orderkey").alias("name"), F.expr(SCENARIO).alias("scenario"), F.when(col("o_custkey") % 3 > 0, "").otherwise(F.concat(F.lit("v"), "o_custkey")).alias("code_value"), F.when(col("o_custkey") % 3 == 1, "orm").alias("orm_code"),
        F.when(col("o_orderkey") % 4 > 0, F.slice(F.array(F.lit("c1"), F.lit("c2")), 1, (col("o_orderkey") % 4 - 1).cast("int"))).alias("callers"), F.array(F.lit("m1"), F.lit(""), F.lit("m2")).alias("metadata"), (col("o_custkey") % 5).alias("sql_pattern_cnt"),
    )
    t = convert.caller_tasks(packs, joining.NEEDS_CALLER)
    return t.select("name", "task", "caller", F.md5("prompt").alias("prompt_md5"), col("prompt").contains("Rule: LIMIT 1").alias("has_rule"), col("prompt").contains("m1\nm2").alias("has_metadata"), "sql_pattern_cnt")


@query
def type_strata(spark, sf):
    """Quotas of a sample stratified by the sorted types of a record's statements."""
    key = F.coalesce(F.nullif(F.array_join(F.array_sort("sql_types"), ","), F.lit("")), F.lit("no_sql"))
    return sampling.quotas(listed(spark, sf).select("record_id", key.alias("types")), "types", 500)


@query
def type_strata_sample(spark, sf):
    key = F.coalesce(F.nullif(F.array_join(F.array_sort("sql_types"), ","), F.lit("")), F.lit("no_sql"))
    found = sampling.stratified(listed(spark, sf).select("record_id", key.alias("types")), "types", 500, "record_id")
    return found.agg(F.count_distinct("record_id").alias("n"), F.count_distinct("types").alias("n_types"))


@query
def case_bounds(spark, sf):
    """How many cases may have how many variants, by scenario and level of each order's case."""
    levels = F.element_at(F.array(*[F.lit(k) for k in scenarios.LEVEL_VARIANTS]), (col("o_custkey") % len(scenarios.LEVEL_VARIANTS) + 1).cast("int"))
    bound = lambda table, key, i: F.element_at(F.create_map(*[F.lit(x) for k, b in table.items() for x in (k, b[i])]), key)
    names = F.element_at(F.array(*[F.lit(k) for k in scenarios.SCENARIO_VARIANTS]), (col("o_orderkey") % len(scenarios.SCENARIO_VARIANTS) + 1).cast("int"))
    o = src.table(spark, sf, "orders").select(names.alias("scenario"), levels.alias("level"))
    b = joining.variant_bounds(*[bound(t, col(k), i) for t, k in ((scenarios.SCENARIO_VARIANTS, "scenario"), (scenarios.LEVEL_VARIANTS, "level")) for i in (0, 1)])
    return o.select("scenario", "level", b.alias("b")).groupBy("scenario", "level", "b.least", "b.most").agg(F.count("*").alias("n"))


# reviews


@query
def fix_recommendations(spark, sf):
    """The lists of a validation's recommendations with their sizes; a list of each kind, empty ones too."""
    from .queries import redundancy_decisions

    return reviews.recommendation_counts(reviews.recommendations(redundancy_decisions(spark, sf)))


@query
def validation_by_part(spark, sf):
    """Totals of each part's validation; parts without candidates have zeros."""
    from .queries import redundancy_decisions

    parts = src.table(spark, sf, "orders").select((col("o_orderkey") % 64).alias("part")).distinct()
    found = redundancy_decisions(spark, sf).where("candidate % 64 % 3 <> 1").select((col("candidate") % 64).alias("part"), "type", "decision")
    return reviews.totals_by(parts, found, "part")


@query
def control_flow_outcomes(spark, sf):
    """Verdicts on records with their regenerated lists counted."""
    r = said.replies(spark, sf, said.REPORT).select("reply_id", responses.verdict(col("reply")).alias("v"))
    again = said.replies(spark, sf, said.REPORT).select((col("reply_id") - 3).alias("reply_id"), responses.regenerated(col("reply")).alias("statements"))
    return reviews.control_flow_summary(r.join(again, "reply_id", "left").select(col("v.is_correct"), col("v.unreadable"), "statements"))


@query
def reanalysis_outcomes(spark, sf):
    o = src.table(spark, sf, "orders")
    rows = o.select(
        (col("o_orderkey") % 7 == 0).alias("failed"), (col("o_orderkey") % 5 == 0).alias("skipped"),
        F.expr(said.nth(['[{"should_generate_sql": false}]', '[{"should_generate_sql": "False "}]', '[{"should_generate_sql": true}]', '["x"]', "[]", '{"should_generate_sql": false}'], "o_custkey")).alias("result"),
    )
    return reviews.reanalysis_summary(rows)


@query
def flat_summary(spark, sf):
    """Summaries with sections as flat metrics."""
    o = src.table(spark, sf, "customer").select(col("c_custkey").alias("record_id"), F.expr(said.nth(['{"a": {"x": 1, "y": "z"}, "b": 3}', '{"b": {"x": 2}, "a": {"x": 9}, "c": null}', '"text"', "{}"], "c_custkey")).alias("summary"))
    return reports.flattened(o, "record_id", "summary")


@query
def judged_votes(spark, sf):
    """Decisions from what judges reply about each statement of a candidate."""
    e = src.table(spark, sf, "events").select((col("event_id") % 300).alias("candidate"), F.expr("CASE event_id % 300 % 3 WHEN 0 THEN 'redundant' WHEN 1 THEN 'new' ELSE 'missing' END").alias("type"), F.expr(said.nth([r for r, *_ in said.VOTES], "(event_id div 7)")).alias("reply"))
    return reviews.decisions(e)


# folders


@query
def mapping_records(spark, sf):
    """Records of mapping folders: the sub-folder of generated statements first, else the folder itself."""
    n = src.table(spark, sf, "nation")
    folder = F.concat(F.lit("m"), "n_regionkey", F.when((col("n_regionkey") < 3) & (col("n_nationkey") % 2 == 1), "/sql_generation").otherwise(""), F.lit("/f"), "n_nationkey", F.lit(".json"))
    body = F.to_json(F.struct("n_nationkey", "n_name"))
    docs = n.select(folder.alias("name"), F.when(col("n_nationkey") % 3 == 0, F.concat(F.lit("["), body, F.lit(",{\"extra\":"), "n_nationkey", F.lit("}]"))).otherwise(body).alias("content"))
    root = files.write_documents(docs, f"{shared_folder(spark)}/loomspark/mappings-{uuid.uuid4().hex}")
    chosen = folders.mapping_files(folders.listing(spark, root), root)
    rows = files.rows_of(folders.read(spark, chosen)).withColumn("mapping", F.regexp_extract("source", "/(m[0-9]+)/", 1))
    return rows.select("mapping", F.try_variant_get("row", "$.n_nationkey", "long").alias("nation"), F.try_variant_get("row", "$.extra", "long").alias("extra"))


@query
def folder_head(spark, sf):
    """The first twelve records of a folder of lists, in file order."""
    n = src.table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_nationkey")).alias("keys"))  # a region's nations
    docs = n.select(F.concat(F.lit("f"), "n_regionkey", F.lit(".json")).alias("name"), F.to_json(F.transform("keys", lambda k: F.struct(k.alias("nation")))).alias("content"))
    root = files.write_documents(docs, f"{shared_folder(spark)}/loomspark/lists-{uuid.uuid4().hex}")
    return folders.load(spark, root, 12).select("number", F.try_variant_get("row", "$.nation", "long").alias("nation"))


@query
def report_folders(spark, sf):
    """The report of each run, with its second name where the first is missing."""
    n = src.table(spark, sf, "nation")
    which = F.when(col("n_nationkey") % 3 == 0, "statistics_summary.json").when(col("n_nationkey") % 3 == 1, "evaluation_summary.json").otherwise("other.json")
    docs = n.select(F.concat(F.lit("run"), F.floor(col("n_nationkey") / 2), F.lit("/"), which).alias("name"), F.concat(F.lit('{"n": '), "n_nationkey", F.lit("}")).alias("content"))
    root = files.write_documents(docs, f"{shared_folder(spark)}/loomspark/runs-{uuid.uuid4().hex}")
    found = folders.reports(folders.listing(spark, root), root)
    return found.select("run", F.regexp_extract("path", "([^/]*)$", 1).alias("report"))


def reward_logs(spark, sf: str) -> str:
    """Writes a log a day of the month: a line an event, some blank or broken."""
    line = F.expr(said.nth(['{"score": 0.9, "function_name": "f"}', "", "broken {", '{"function_name": "g"}', '{"score": 0.45}'], "event_id"))
    e = src.table(spark, sf, "events").select((col("event_id") % 30).alias("log"), "event_id", line.alias("value"))
    root = f"{shared_folder(spark)}/loomspark/logs-{uuid.uuid4().hex}"
    e.repartition("log").sortWithinPartitions("log", "event_id").select("log", "value").write.partitionBy("log").text(root)
    return root


@query
def reward_lines(spark, sf):
    """Scored lines of reward logs with their numbers."""
    rows = reward_log.read(spark, reward_logs(spark, sf), False, True)
    return rows.select(F.regexp_extract("source", "/log=([0-9]+)/", 1).cast("int").alias("log"), "line_number", "score", "band")


@query
def field_sides(spark, sf):
    """Which fields records of two kinds have: left only, right only, or both."""
    o = src.table(spark, sf, "orders")
    row = F.expr(said.nth(['{"id": 1, "a": 1}', '{"id": 2, "b": null}', '{"id": 3, "c": {"d": 1}}', '{"id": 4, "a": 2, "c": 3}'], "o_orderkey"))
    both = o.select("o_orderkey", F.parse_json(row).alias("row"))
    return files.field_sides(both.where("o_orderkey % 2 = 0"), both.where("o_orderkey % 2 = 1"))


@query
def dataset_size(spark, sf):
    """Records and their size as JSON."""
    r = src.records(spark, sf)
    return r.agg(F.count("*").alias("records"), F.sum(F.length(F.to_json(F.struct("record_id", "caller", "pattern_cnt")))).alias("characters"))


# inputs, prompts, settings


@query
def root_shapes(spark, sf):
    """Records of files whose root is a list, an object that holds one under a known name, or one object."""
    o = src.table(spark, sf, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source"), F.expr(said.nth(ROOTS, "o_orderkey")).alias("content"))
    return files.rows_of(o).select("source", "pos", F.try_variant_get("row", "$.n", "int").alias("n"))


ROOTS = ['[{"n": 1}, {"n": 2}]', '{"records": [{"n": 3}]}', '{"data": [{"n": 4}, {"n": 5}, {"n": 6}]}', '{"items": []}', '{"results": [{"n": 7}], "n": 9}', '{"n": 8}', "broken", '"text"']


@query
def mapped_rows(spark, sf):
    """Rows of a root that maps samples to them, with the key as sample."""
    o = src.table(spark, sf, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source"), F.concat(F.lit('{"a'), "o_custkey", F.lit('": {"n": '), "o_orderkey", F.lit('}, "b": {"n": 1}}')).alias("content"))
    return files.map_rows(o).select("source", "sample_id", F.try_variant_get("row", "$.n", "long").alias("n"))


CHECKED = ['{"f": {"code_value": null}, "g": {}}', '[{"code_value": "x"}, 5, {"a": 1}]', "7", "[", "[]", '{"h": 3}']


@query
def input_warnings(spark, sf):
    o = src.table(spark, sf, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("source"), F.expr(said.nth(CHECKED, "o_orderkey")).alias("content"))
    return files.input_warnings(o)


@query
def keyword_status(spark, sf):
    """Keywords that replies name, and which records got no answer."""
    from ..operators import clean

    r = src.records(spark, sf)
    reply = F.expr(said.nth(['["Preload", "save"]', "No", "", "uses pluck and Scopes", "[x, Hooks]"], "event_id"))
    replies = src.table(spark, sf, "events").select(col("event_id").alias("record_id"), reply.alias("reply"))
    return clean.tag_keywords(r, replies).select("record_id", F.array_join("keywords", "|").alias("keywords"), "has_keywords", "status")


@query
def prompt_layouts(spark, sf):
    """Metadata in each of its layouts."""
    meta = F.array(F.struct(F.lit("k").alias("code_key"), col("o_custkey").cast("string").alias("code_value"), F.lit("f.go").alias("code_file")), F.struct(F.lit("l").alias("code_key"), F.lit("w").alias("code_value"), F.lit(None).cast("string").alias("code_file")))
    o = src.table(spark, sf, "orders").withColumn("meta", meta)
    return o.select("o_orderkey", *[prompts.metadata_layout(col("meta"), n).alias(n) for n in ("plain", "numbered", "files", "fenced", "values")], convert.metadata_text(col("meta")).alias("rl"), convert.metadata_text(col("meta"), "\n", "\n\n").alias("sft"))


@query
def reward_by_settings(spark, sf):
    """Rewards with the weights of a run's settings."""
    from .config import Settings
    from .queries import rewards

    own = Settings.of('{"rewards": {"validity": 0.5, "consistency": 0.25, "keyword": 0.25, "penalty_cap": 0.125}}')
    return rewards(spark, sf).select("doc_id", scoring.reward_by(own, col("validity"), col("consistency"), col("keyword"), col("severity")).alias("reward"))


PARTED = ['[{"code_file": "f", "code_start_line": 1, "code_end_line": 2, "code_key": "k", "code_value": "v", "code_label": 3, "code_type": 0}, {"code_key": null, "code_label": 0}, "x", {}]', "[]", "null"]


@query
def metadata_parts(spark, sf):
    o = src.table(spark, sf, "orders").select("o_orderkey", F.parse_json(F.expr(said.nth(PARTED, "o_orderkey"))).alias("meta"))
    return o.select("o_orderkey", convert.metadata_parts(col("meta")).alias("text"))
