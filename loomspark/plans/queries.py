"""The queries: each applies an operator to inputs derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import responses, text
from ..functions.fingerprint import fingerprint
from ..operators import catalog, clean, diff, sampling, scoring
from ..sources import adapters as src
from ..sources import records as files
from .staging import stage

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def col(name: str):
    return F.col(name)


def audit_fp(spark, sf: str) -> DataFrame:
    return fingerprint(src.audit_log(spark, sf))


def halves(spark, sf: str) -> tuple[DataFrame, DataFrame]:
    """Catalog: statements of even number; corpus: those of odd number. Texts are parsed once for both."""
    fps = stage(audit_fp(spark, sf), "audit")
    return fps.where("stmt_id % 2 = 0"), fps.where("stmt_id % 2 = 1")


def item_fp(spark, sf: str) -> DataFrame:
    return fingerprint(src.items(spark, sf).where("sql_text <> ''"))


def statements(spark, sf: str) -> DataFrame:
    """(record_id, orm_code, caller, sql_text, fp, seen): the statement that stands n-th in a record is seen at 16 * record + n."""
    owners = src.records(spark, sf).select("record_id", "orm_code", "caller")
    seen = F.col("record_id") * 16 + F.col("item_pos") + F.col("variant_pos")
    found = item_fp(spark, sf).join(owners, "record_id").select("record_id", "orm_code", "caller", "item_pos", "variant_pos", "sql_text", "fp", seen.alias("seen"))
    return stage(found, "statements")


# fingerprints and catalogs


@query
def fingerprint_coverage(spark, sf):
    return catalog.coverage_of(audit_fp(spark, sf), col("stmt_id") % 2 == 0)


@query
def fingerprint_class_counts(spark, sf):
    return audit_fp(spark, sf).groupBy("fp").agg(F.count("*").alias("n"), F.first(text.is_excluded(col("fp"))).alias("excluded"))


@query
def normalize_sql(spark, sf):
    return src.audit_log(spark, sf).select("stmt_id", text.normalize_sql(col("sql_text")).alias("normal"))


@query
def system_function_probe(spark, sf):
    return src.audit_log(spark, sf).withColumn("name", text.system_function(col("sql_text"))).where("name is not null").groupBy("name").agg(F.count("*").alias("n"))


@query
def looks_like_sql(spark, sf):
    return src.audit_log(spark, sf).groupBy(text.looks_like_sql(col("sql_text")).alias("is_sql")).agg(F.count("*").alias("n"))


@query
def catalog_build(spark, sf):
    return catalog.build(audit_fp(spark, sf), "stmt_id")


@query
def catalog_match_pairs(spark, sf):
    cat, corpus = halves(spark, sf)
    return catalog.match(corpus.select("stmt_id", "fp"), cat).select("stmt_id", "fp", "in_catalog")


@query
def catalog_match_summary(spark, sf):
    fps = stage(item_fp(spark, sf), "items")
    cat, corpus = fps.where("record_id % 2 = 0"), fps.where("record_id % 2 = 1")
    return catalog.match_summary(catalog.units(catalog.match(corpus, cat)))


@query
def match_single(spark, sf):
    cat, corpus = halves(spark, sf)
    known = catalog.build(cat, "stmt_id").select("fp", col("first_sql").alias("example_sql"), col("n_sql").alias("example_count"))
    return corpus.select("stmt_id", "fp").join(known, "fp", "left").select("stmt_id", "fp", col("example_sql").isNotNull().alias("matched"), "example_sql", F.coalesce("example_count", F.lit(0)).alias("example_count"), text.is_excluded(col("fp")).alias("excluded"))


@query
def unmatched_fingerprints(spark, sf):
    cat, corpus = halves(spark, sf)
    return catalog.unmatched(catalog.build(cat, "stmt_id"), corpus)


@query
def coverage_by_type(spark, sf):
    cat, corpus = halves(spark, sf)
    return catalog.coverage_by_type(catalog.build(cat, "stmt_id"), corpus, text.sql_type_with_transactions(col("first_sql")))


@query
def table_name_fallback(spark, sf):
    cat, corpus = halves(spark, sf)
    typed = lambda d: d.withColumn("sql_type", text.classify_sql(col("sql_text")))
    return catalog.fallback_by_table(typed(corpus), typed(cat).withColumn("seen", col("stmt_id"))).drop("found_fp")


@query
def tables_per_fingerprint(spark, sf):
    ranked = audit_fp(spark, sf).withColumn("k", F.row_number().over(Window.partitionBy("fp").orderBy("stmt_id"))).where("k <= 10")
    return ranked.groupBy("fp").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tables")))).alias("tables"))


@query
def table_frequency(spark, sf):
    return audit_fp(spark, sf).select(F.explode("tables").alias("table")).groupBy("table").agg(F.count("*").alias("n"))


@query
def sql_equivalence(spark, sf):
    items = src.items(spark, sf).where("sql_text <> ''")
    return items.groupBy(text.comparable(col("sql_text")).alias("comparable")).agg(F.count("*").alias("n"), F.count_distinct("sql_text").alias("n_texts"))


@query
def unique_patterns(spark, sf):
    return src.items(spark, sf).where("item_kind = 'STRING'").select("sql_text").distinct()


# statistics and reports


def listed(spark, sf: str) -> DataFrame:
    """Records with their number of items and types of statements."""
    n = src.items(spark, sf).groupBy("record_id").agg(F.count_distinct("item_pos").alias("n_items"), F.array_sort(F.collect_set(text.classify_sql(col("sql_text")))).alias("sql_types"))
    met = src.records(spark, sf).join(n, "record_id", "left")
    return met.withColumn("n_items", F.coalesce("n_items", F.lit(0))).withColumn("sql_types", F.coalesce("sql_types", F.array().cast("array<string>")))


@query
def dataset_statistics(spark, sf):
    return listed(spark, sf).agg(
        F.count("*").alias("total"), F.count_if(col("n_items") > 0).alias("with_sql"), F.round(100 * F.avg((col("n_items") > 0).cast("double")), 6).alias("coverage"),
        F.round(F.avg("n_items"), 6).alias("mean_items"), F.count_distinct("source_file").alias("n_files"),
    )


@query
def sql_type_distribution(spark, sf):
    return listed(spark, sf).select(F.explode("sql_types").alias("sql_type")).groupBy("sql_type").agg(F.count("*").alias("n"))


@query
def top_files(spark, sf):
    return src.records(spark, sf).groupBy("source_file").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_file").limit(10)


@query
def file_statistics(spark, sf):
    return listed(spark, sf).groupBy("source_file").agg(F.count("*").alias("n"), F.count_if(col("n_items") > 0).alias("n_with_sql"), F.round(F.avg("n_items"), 6).alias("mean_items"))


@query
def filter_records(spark, sf):
    r = listed(spark, sf)
    keep = (F.size("sql_types") > 0) & F.arrays_overlap("sql_types", F.array(F.lit("UPDATE"), F.lit("DELETE"))) & (col("n_items") >= 2) & col("function_name").contains("get") & col("source_file").rlike(r"^part1.*\.json$")
    return r.where(keep).select("record_id", "n_items")


@query
def project_records(spark, sf):
    return src.records(spark, sf).where(col("function_name").contains("proj3")).select("record_id", "function_name")


@query
def keyword_tag(spark, sf):
    r = src.records(spark, sf).withColumn("matched_keywords", text.matched_keywords(col("code_value"), col("orm_code")))
    return r.where(F.size("matched_keywords") > 0).select("record_id", F.array_join("matched_keywords", "|").alias("keywords"))


@query
def keyword_frequency(spark, sf):
    names = spark.createDataFrame([(k,) for k in text.GORM_KEYWORDS], "keyword string")
    hits = src.records(spark, sf).select(F.explode(text.matched_keywords(col("code_value"), col("orm_code"))).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))
    return names.join(hits, "keyword", "left").select("keyword", F.coalesce("n", F.lit(0)).alias("n"))


@query
def keyword_partitions(spark, sf):
    return src.records(spark, sf).select("source_file", F.explode(text.matched_keywords(col("code_value"), col("orm_code"))).alias("keyword")).groupBy("keyword", "source_file").agg(F.count("*").alias("n"))


@query
def control_flow_detect(spark, sf):
    return src.records(spark, sf).where(text.has_control_flow(col("orm_code"))).select("record_id")


@query
def classify_sql(spark, sf):
    items = src.items(spark, sf)
    kind = F.when(col("item_kind") == "PARAM_DEPENDENT", "PARAM_DEPENDENT").otherwise(text.classify_sql(col("sql_text")))
    return items.where("variant_pos = 0").groupBy(kind.alias("sql_type")).agg(F.count("*").alias("n"))


@query
def sql_type_report(spark, sf):
    a = src.audit_log(spark, sf)
    return a.groupBy(text.sql_type_with_ddl(col("sql_text")).alias("with_ddl"), text.sql_type_with_transactions(col("sql_text")).alias("with_transactions")).agg(F.count("*").alias("n"))


@query
def complexity_report(spark, sf):
    a = src.audit_log(spark, sf)
    return a.groupBy(text.complexity(col("sql_text")).alias("complexity")).agg(F.count("*").alias("n"), F.sum(text.complexity_score(col("sql_text"))).alias("score"))


@query
def pattern_flags(spark, sf):
    return src.audit_log(spark, sf).select(F.explode(text.pattern_flags(col("sql_text"))).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


@query
def error_classes(spark, sf):
    msg = F.expr("CASE event_id % 5 WHEN 0 THEN 'bad JSON' WHEN 1 THEN 'SQL and json' WHEN 2 THEN 'read Timeout' WHEN 3 THEN 'out of memory' ELSE 'other sqlite' END")
    return src.table(spark, sf, "events").groupBy(text.error_class(msg).alias("error_class")).agg(F.count("*").alias("n"))


@query
def naming_styles(spark, sf):
    name = text.pure_name(col("function_name"))
    return src.records(spark, sf).groupBy(text.naming_style(name).alias("style")).agg(F.count("*").alias("n"), F.count_distinct(name).alias("n_names"), F.round(F.avg(F.length(name)), 6).alias("mean_length"))


@query
def name_affixes(spark, sf):
    names = src.records(spark, sf).select(text.pure_name(col("function_name")).alias("name")).where("length(name) > 3")
    ends = names.select(F.explode(F.array(F.struct(F.lit("prefix").alias("kind"), F.left("name", F.lit(3)).alias("affix")), F.struct(F.lit("suffix").alias("kind"), F.right("name", F.lit(3)).alias("affix")))).alias("x")).select("x.*")
    counts = ends.groupBy("kind", "affix").agg(F.count("*").alias("n"))
    return counts.withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "affix"))).where("k <= 10").drop("k")


@query
def sql_complexity_profile(spark, sf):
    s = src.items(spark, sf).where("item_kind = 'STRING' and sql_text <> ''")
    hard = text.any_of(text.COMPLEX, lambda w: F.upper("sql_text").contains(w))
    return s.agg(
        F.count_if(hard).alias("complex"), F.count_if(~hard).alias("simple"), F.round(F.avg(F.length("sql_text")), 6).alias("mean_length"), F.median(F.length("sql_text")).alias("median_length"),
        F.min(F.length("sql_text")).alias("min_length"), F.max(F.length("sql_text")).alias("max_length"),
    )


@query
def sql_keyword_frequency(spark, sf):
    s = src.items(spark, sf).where("item_kind = 'STRING'")
    hits = F.array_compact(F.array(*[F.when(F.upper("sql_text").contains(k), k) for k in text.ANALYSED_KEYWORDS]))
    return s.select(F.explode(hits).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))


@query
def join_patterns(spark, sf):
    up = F.upper("sql_text")
    kind = F.when(up.contains("LEFT JOIN"), "LEFT JOIN").when(up.contains("RIGHT JOIN"), "RIGHT JOIN").when(up.contains("INNER JOIN"), "INNER JOIN").when(up.contains("JOIN"), "SIMPLE JOIN")
    return src.audit_log(spark, sf).select("sql_text").union(src.items(spark, sf).select("sql_text")).withColumn("kind", kind).where("kind is not null").groupBy("kind").agg(F.count("*").alias("n"))


@query
def project_distribution(spark, sf):
    r = listed(spark, sf).withColumn("project", text.project(col("function_name"))).where("project is not null")
    return r.groupBy("project").agg(F.count("*").alias("n"), F.count_if(col("n_items") > 0).alias("n_with_sql"), F.round(F.avg("n_items"), 6).alias("mean_items"), F.round(100 * F.avg((col("n_items") > 0).cast("double")), 6).alias("coverage"))


@query
def code_patterns(spark, sf):
    r = src.records(spark, sf)
    return r.agg(
        F.round(F.avg(F.length("orm_code")), 6).alias("mean_length"), F.median(F.length("orm_code")).alias("median_length"), F.count_if(col("caller") != "").alias("with_caller"),
        F.count_if(text.any_of(text.ORM_WORDS, lambda w: col("orm_code").contains(w))).alias("with_orm"), F.count_if(text.any_of(text.ERROR_WORDS, lambda w: col("orm_code").contains(w))).alias("with_error"),
        *[F.count_if(text.language(col("code_value")) == n).alias(n.lower()) for n in ("Go", "Python", "JavaScript")],
    )


@query
def quality_report(spark, sf):
    share = lambda c: F.round(100 * F.avg(c.cast("double")), 6)
    return listed(spark, sf).agg(
        share(col("function_name") != "").alias("function_name"), share(col("orm_code") != "").alias("orm_code"), share(col("n_items") > 0).alias("statements"), share(F.size("sql_types") > 0).alias("types"),
        share(col("code_value") != "").alias("metadata"), share(col("source_file") != "").alias("source_file"), share((col("n_items") > 0) & (F.size("sql_types") > 0)).alias("alignment"),
        share(col("function_name").contains(":") & col("function_name").contains("/")).alias("name_format"),
    )


@query
def cjk_rows(spark, sf):
    return src.items(spark, sf).groupBy(text.has_cjk(col("sql_text")).alias("cjk")).agg(F.count("*").alias("n"))


@query
def pattern_count_agreement(spark, sf):
    return listed(spark, sf).groupBy((col("n_items") == col("pattern_cnt")).alias("agrees")).agg(F.count("*").alias("n"))


@query
def scenario_rules(spark, sf):
    names = F.expr("CASE event_id % 6 WHEN 0 THEN 'with_first' WHEN 1 THEN 'with_take' WHEN 2 THEN 'with_last' WHEN 3 THEN 'with_count' WHEN 4 THEN 'with_find_no_limit' ELSE 'plain' END")
    rules = F.create_map(*[F.lit(x) for kv in text.SCENARIO_RULES.items() for x in kv])
    return src.table(spark, sf, "events").groupBy(names.alias("scenario")).agg(F.count("*").alias("n")).withColumn("rule", F.coalesce(F.try_element_at(rules, col("scenario")), F.lit("")))


@query
def valid_sql_documents(spark, sf):
    d = src.table(spark, sf, "documents")
    return d.groupBy("lang", text.is_valid_sql(col("text")).alias("valid")).agg(F.count("*").alias("n"))


# cleaning and tags


@query
def clean_sql_items(spark, sf):
    return clean.removed_items(src.items(spark, sf))


@query
def clean_records(spark, sf):
    return clean.clean_records(src.records(spark, sf), src.items(spark, sf)).select("record_id", "list_state", F.array_join("statements", " ## ").alias("statements"))


@query
def cleaning_counters(spark, sf):
    return clean.cleaning_counters(src.records(spark, sf), src.items(spark, sf))


@query
def remove_no_sql(spark, sf):
    return clean.no_sql(src.records(spark, sf), src.items(spark, sf)).where("not is_no_sql").select("record_id", "list_state")


def record_replies(spark, sf: str) -> DataFrame:
    return src.replies(spark, sf).select(col("reply_id").alias("record_id"), "reply")


@query
def completeness_tag(spark, sf):
    return clean.tag_completeness(src.records(spark, sf), record_replies(spark, sf))


@query
def correctness_tag(spark, sf):
    return clean.tag_correctness(src.records(spark, sf), record_replies(spark, sf))


@query
def reanalysis_selection(spark, sf):
    r = src.records(spark, sf).where("list_state = 'NO_SQL'").join(record_replies(spark, sf), "record_id", "left")
    got = responses.parse_reply(F.coalesce("reply", F.lit("")))
    return r.select("record_id", F.coalesce(F.nullif(col("orm_code"), F.lit("")), col("code_value")).alias("code"), (F.size(got) > 0).alias("has_new_sql"))


@query
def reanalysis_summary(spark, sf):
    return reanalysis_selection(spark, sf).agg(F.count("*").alias("total"), F.count_if("has_new_sql").alias("generated"), F.count_if(~col("has_new_sql")).alias("kept"))


@query
def align_schema(spark, sf):
    """Records as JSON text through the reader of record files."""
    o = src.table(spark, sf, "orders")
    js = F.to_json(F.struct(F.expr(src.FUNCTION_NAME).alias("function_name"), F.when(col("o_orderkey") % 2 == 0, F.expr(src.ORM_CODE)).alias("orm_code"), F.when(col("o_orderkey") % 3 == 0, F.array(F.lit("SELECT 1;"), F.lit("x"))).alias("sql_statement_list")))
    rows = o.select(F.lit("orders").alias("source"), F.concat(F.lit('{"records": ['), js, F.lit("]}")).alias("content"), "o_orderkey")
    aligned = files.align(files.rows_of(rows.select(F.col("o_orderkey").cast("string").alias("source"), "content")))
    return aligned.select(F.split("record_id", "#")[0].cast("long").alias("record_id"), "function_name", "orm_code", "caller", "list_state", "sql_pattern_cnt", F.size("code_meta_data").alias("n_meta"))


@query
def ingest_items(spark, sf):
    """Heterogeneous lists, as JSON, to statement rows."""
    o = src.table(spark, sf, "orders")
    js = F.expr("""CASE o_orderkey % 4
      WHEN 0 THEN '["SELECT ' || o_custkey || ';", ["A", "B"]]' WHEN 1 THEN '[{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "U' || o_custkey || '"}, {"scenario": "t", "sql": ["V", "W"]}]}]'
      WHEN 2 THEN '"<NO SQL GENERATE>"' ELSE '[]' END""")
    content = F.concat(F.lit('[{"function_name": "f", "sql_statement_list": '), js, F.lit("}]"))
    items = files.items_of(files.align(files.rows_of(o.select(col("o_orderkey").cast("string").alias("source"), content.alias("content")))))
    return items.select(F.split("record_id", "#")[0].cast("long").alias("record_id"), "item_pos", "sub_pos", "item_kind", "variant_pos", "scenario", "sql_pos", "sql_text")


@query
def export_csv(spark, sf):
    r = listed(spark, sf).withColumn("n_statements", col("n_items")).withColumn("orm_code", F.repeat("orm_code", F.lit(5)))
    return files.export_projection(r)


# callers and fixes


@query
def caller_fingerprints(spark, sf):
    return diff.caller_sets(statements(spark, sf)).select("orm_code", "caller", F.array_join("fps", ",").alias("fps"), "n_sql", "first_seen", "n_fp")


@query
def reference_callers(spark, sf):
    return diff.reference_callers(diff.caller_sets(statements(spark, sf))).select("orm_code", "caller", "n_fp", "n_sql")


def diffs(spark, sf: str) -> DataFrame:
    return diff.caller_diff(diff.caller_sets(statements(spark, sf)))


@query
def caller_diff(spark, sf):
    d = diffs(spark, sf)
    return d.select("orm_code", "caller", "reference", F.array_join("common", ",").alias("common"), F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "is_subset", "is_superset", F.round("jaccard", 6).alias("jaccard"))


@query
def diff_candidates(spark, sf):
    return diff.candidates(diffs(spark, sf)).groupBy("orm_code", "type").agg(F.count("*").alias("n"), F.sum(F.size("fps")).alias("n_fps"))


@query
def candidate_queue(spark, sf):
    return diff.candidate_queue(diff.candidates(diffs(spark, sf)), 50).select("orm_code", "caller", "type", "validation_no", "priority")


@query
def mark_redundant(spark, sf):
    s = statements(spark, sf)
    marked = diff.mark_redundant(s, diff.candidates(diff.caller_diff(diff.caller_sets(s))))
    return marked.groupBy("record_id").agg(F.count("*").alias("n"), F.count_if("is_redundant").alias("n_redundant"))


@query
def orm_summary(spark, sf):
    c = diff.candidates(diffs(spark, sf))
    return c.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("orm_code").alias("n_methods"), F.round(F.count("*") / F.count_distinct("orm_code"), 6).alias("per_method"))


def decisions(spark, sf: str) -> DataFrame:
    """Removals of DELETE statements and additions, with a review of every third."""
    r = src.records(spark, sf).where("record_id % 5 = 3 and list_state = 'LIST' and orm_code <> ''").select("record_id", "orm_code", "caller")
    acts = F.explode(F.array(F.struct(F.lit("remove").alias("action"), F.lit("DELETE FROM line1 WHERE id IN (1, 2)").alias("sql_text")), F.struct(F.lit("add").alias("action"), F.lit("SELECT 1").alias("sql_text"))))
    d = r.select("record_id", "orm_code", "caller", acts.alias("a")).select("record_id", "orm_code", "caller", "a.*")
    return d.withColumn("accepted", F.when(col("record_id") % 3 == 0, False)).withColumn("replacement", F.when(col("record_id") % 6 == 0, "SELECT 2"))


@query
def fix_maps(spark, sf):
    gone, more = diff.fix_maps(decisions(spark, sf))
    return gone.withColumn("action", F.lit("remove")).unionByName(more.withColumn("action", F.lit("add")))


@query
def apply_fixes(spark, sf):
    items = src.items(spark, sf).withColumn("sql_text", F.when(col("record_id") % 2 == 0, F.concat("sql_text", F.lit(text.REDUNDANT))).otherwise(col("sql_text")))
    fixed = diff.apply_fixes(src.records(spark, sf), items, *diff.fix_maps(decisions(spark, sf)), text.REDUNDANT)
    return fixed.select("record_id", "touched", F.array_join("statements", " ## ").alias("statements"))


@query
def keyword_split(spark, sf):
    r = src.records(spark, sf).withColumn("key", F.concat_ws(":", "function_name", F.left("orm_code", F.lit(100)), "caller"))
    tagged = r.where(F.size(text.matched_keywords(col("code_value"), col("orm_code"))) > 0)
    return diff.split_by_key(r, tagged, ["key"]).select("record_id")


@query
def merge_back(spark, sf):
    r = src.records(spark, sf).withColumn("key", col("record_id") % 700)
    done = src.table(spark, sf, "events").select((col("event_id") % 900).alias("key"), "event_id", F.when(col("event_id") % 2 == 0, F.concat(F.lit("new"), "event_id")).alias("caller"))
    return diff.merge_back(r.select("record_id", "key", "caller"), done, "key", "event_id", ["caller"])


@query
def concat_final(spark, sf):
    r = src.records(spark, sf)
    return r.where("record_id % 2 = 0").select("record_id", F.lit("keyword").alias("part")).unionByName(r.where("record_id % 3 = 0").select("record_id", F.lit("rest").alias("part")))


@query
def dataset_compare(spark, sf):
    fps = stage(item_fp(spark, sf).select("record_id", "item_pos", "fp"), "items")
    other = fps.where("(record_id + item_pos) % 4 <> 0 and record_id % 11 <> 0").select("record_id", F.when(col("item_pos") == 3, F.lit("added")).otherwise(col("fp")).alias("fp"))
    d = diff.compare_sets(fps, other, "record_id")
    return d.select("record_id", "matched", F.array_join("common", ",").alias("common"), F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "n_left", "n_right", "n_common", "n_missing", "n_extra")


@query
def condition_labels(spark, sf):
    r = src.records(spark, sf)
    keys = r.where("record_id % 6 = 1").select("function_name", "orm_code", "caller").distinct().withColumn("hit", F.lit(True))
    met = r.join(keys, ["function_name", "orm_code", "caller"], "left")
    tags = F.array_compact(F.array(F.when(col("hit"), "if-else"), F.when(F.size(text.matched_keywords(col("code_value"), col("orm_code"))) > 0, "keyword")))
    return met.select("record_id", F.array_join(F.array_sort(tags), "|").alias("condition"))


@query
def condition_distribution(spark, sf):
    return condition_labels(spark, sf).groupBy("condition").agg(F.count("*").alias("n"))


@query
def clean_labels(spark, sf):
    labels = condition_labels(spark, sf)
    keep = F.filter(F.split("condition", r"\|"), lambda t: (t == "keyword") | ((t == "if-else") & (col("record_id") % 2 == 1)))
    return labels.select("record_id", F.array_join(keep, "|").alias("condition"), (F.array_join(keep, "|") != col("condition")).alias("changed"))


@query
def field_set_difference(spark, sf):
    names = lambda t: spark.createDataFrame([(c.split("_", 1)[1],) for c in src.table(spark, sf, t).columns], "field string")
    left, right = names("customer").withColumn("l", F.lit(True)), names("supplier").withColumn("r", F.lit(True))
    return left.join(right, "field", "full").select("field", F.when(col("r").isNull(), "left").when(col("l").isNull(), "right").otherwise("both").alias("side"))


@query
def pack_callers(spark, sf):
    o = src.table(spark, sf, "orders").select(col("o_orderkey").alias("pack"), F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'mutual_exclusive_conditions' ELSE 'plain' END").alias("scenario"), F.expr("transform(sequence(1, cast(o_custkey % 3 as int) + 1), i -> 'c' || i)").alias("callers"))
    o = o.withColumn("callers", F.expr("slice(callers, 1, size(callers) - 1)"))
    own = o.where("scenario <> 'mutual_exclusive_conditions'").select("pack", "scenario", F.lit("").alias("caller"))
    return own.unionByName(o.select("pack", "scenario", F.explode("callers").alias("caller")))


# replies


@query
def parse_responses(spark, sf):
    return src.replies(spark, sf).select("reply_id", F.array_join(responses.parse_reply(col("reply")), " ## ").alias("statements"))


@query
def statements_by_verb(spark, sf):
    return src.replies(spark, sf).select("reply_id", F.array_join(responses.statements_by_verb(col("reply")), " ## ").alias("statements"))


@query
def harvest_sql(spark, sf):
    return src.replies(spark, sf).select("reply_id", F.array_join(responses.harvest(col("reply")), " ## ").alias("statements"))


@query
def syntax_check(spark, sf):
    return src.audit_log(spark, sf).groupBy(text.is_simple_sql(col("sql_text")).alias("ok")).agg(F.count("*").alias("n"))


@query
def validate_output_format(spark, sf):
    checks = ("json", "boolean", "list", "completeness", "keyword", "regeneration", "sql_generation", "precheck")
    return src.replies(spark, sf).select("reply_id", *[responses.validator(n)(col("reply")).alias(n) for n in checks])


@query
def keyword_responses(spark, sf):
    return src.replies(spark, sf).select("reply_id", F.array_join(responses.keywords_of(col("reply")), "|").alias("keywords"))


@query
def first_valid_attempt(spark, sf):
    a = src.replies(spark, sf).withColumn("sample", F.floor(col("reply_id") / 3).cast("long")).withColumn("attempt", col("reply_id") % 3)
    good = a.where(responses.validator("regeneration")(col("reply")))
    return a.select("sample").distinct().join(good.groupBy("sample").agg(F.min("attempt").alias("attempt")), "sample", "left")


# decisions, evaluation, scores


def votes(spark, sf: str) -> DataFrame:
    return src.table(spark, sf, "lineitem").select(col("l_orderkey").alias("candidate"), F.expr("CASE l_orderkey % 3 WHEN 0 THEN 'redundant' WHEN 1 THEN 'new' ELSE 'missing' END").alias("type"), (col("l_partkey") % 3 < 2).alias("confirmed"))


@query
def redundancy_decisions(spark, sf):
    share = votes(spark, sf).groupBy("candidate", "type").agg(F.avg(col("confirmed").cast("double")).alias("share"))
    ok = col("share") >= 0.6
    decision = F.when(col("type") == "missing", F.when(ok, "add").otherwise("keep")).otherwise(F.when(ok, "remove").otherwise("keep"))
    return share.select("candidate", "type", F.round("share", 6).alias("share"), decision.alias("decision"))


@query
def validation_counters(spark, sf):
    return redundancy_decisions(spark, sf).groupBy("type", "decision").agg(F.count("*").alias("n"))


@query
def control_flow_totals(spark, sf):
    r = src.records(spark, sf).where(text.has_control_flow(col("orm_code"))).join(record_replies(spark, sf), "record_id", "left")
    verdict = F.when(col("reply").isNull() | (col("reply") == ""), "error").when(col("reply").startswith("否"), "incorrect").otherwise("correct")
    n = lambda v: F.count_if(verdict == v)
    return r.agg(F.count("*").alias("detected"), n("correct").alias("correct"), n("incorrect").alias("incorrect"), n("error").alias("error"), F.coalesce(F.round(F.try_divide(n("correct").cast("double"), F.count("*")), 6), F.lit(0.0)).alias("rate"))


def evaluated(spark, sf: str) -> DataFrame:
    """A sample per user: its statements, how many are valid and how many match the catalog."""
    cat, corpus = halves(spark, sf)
    m = catalog.match(corpus.select("user_id", "stmt_id", "fp"), cat)
    valid = ~text.is_excluded(col("fp"))
    return m.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(valid).alias("valid"), F.count_if(valid & col("in_catalog")).alias("matched"))


@query
def eval_statistics(spark, sf):
    return evaluated(spark, sf).agg(
        F.count("*").alias("samples"), F.count_if(col("valid") >= 1).alias("with_valid"), F.count_if(col("matched") >= 1).alias("with_match"), F.sum("n").alias("statements"), F.sum("valid").alias("valid"), F.sum("matched").alias("matched"),
        F.round(F.coalesce(F.try_divide(F.sum("matched").cast("double"), F.sum("valid")), F.lit(0.0)), 6).alias("match_rate"),
    )


def quality(spark, sf: str) -> DataFrame:
    score = F.lit(1) + (col("n") > 0).cast("int") + (col("valid") > 0).cast("int") + 2 * (col("matched") > 0).cast("int")
    return evaluated(spark, sf).withColumn("score", score)


@query
def quality_scores(spark, sf):
    band = F.when(col("score") >= 4, "high").when(col("score") >= 2, "medium").otherwise("low")
    return quality(spark, sf).groupBy("score", band.alias("band")).agg(F.count("*").alias("n"))


@query
def examples_per_class(spark, sf):
    kind = F.when(col("score") >= 5, "excellent").when(col("score") >= 3, "good").otherwise("poor")
    ranked = quality(spark, sf).withColumn("kind", kind).withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy("user_id")))
    return ranked.where("k <= 3").select("kind", "k", "user_id", "score")


@query
def coverage_analysis(spark, sf):
    cat, corpus = halves(spark, sf)
    top = corpus.join(cat.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.count("*").alias("n"))
    return top.orderBy(F.desc("n"), "fp").limit(20)


@query
def viewer_summary(spark, sf):
    r = listed(spark, sf)
    param = src.items(spark, sf).where("item_kind = 'PARAM_DEPENDENT'").groupBy("record_id").agg(F.count("*").alias("variants"))
    flow = col("orm_code").contains("switch") | col("orm_code").contains("if")
    met = r.join(param, "record_id", "left")
    out = met.groupingSets([[col("source_file")], []], col("source_file")).agg(
        F.count("*").alias("n"), F.count_if(col("n_items") > 0).alias("with_sql"), F.count_if(col("n_items") == 0).alias("without_sql"), F.count("variants").alias("param_dependent"), F.count_if(flow).alias("control_flow"), F.coalesce(F.sum("variants"), F.lit(0)).alias("variants"),
    )
    return out.withColumn("source_file", F.coalesce("source_file", F.lit("ALL")))


def rewards(spark, sf: str) -> DataFrame:
    d = src.table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    x = lambda m: (col("doc_id") % m) / F.lit(float(m))
    return d.select("doc_id", x(8).alias("validity"), x(5).alias("consistency"), F.when(col("toxic") == 1, x(3)).alias("keyword"), x(7).alias("branch"), (x(4) * col("quality")).alias("severity"))


@query
def reward_v2(spark, sf):
    return rewards(spark, sf).select("doc_id", F.round(scoring.reward_v2(col("validity"), col("consistency"), col("keyword"), col("severity")), 2).alias("reward"))


@query
def reward_five_dim(spark, sf):
    return rewards(spark, sf).select("doc_id", scoring.reward_five(col("validity"), col("consistency"), col("keyword"), col("branch"), col("severity")).alias("reward"))


@query
def composite_reward(spark, sf):
    return rewards(spark, sf).select("doc_id", scoring.composite(col("validity"), col("consistency"), col("branch"), col("severity"), F.lit(1.0), (col("doc_id") % 2).cast("double")).alias("reward"))


@query
def branch_exclusivity(spark, sf):
    r = rewards(spark, sf)
    return r.select("doc_id", F.round(scoring.branch_score(F.when(col("doc_id") % 3 == 0, 0.0).otherwise(col("keyword")), col("branch"), F.lit(1.5)), 6).alias("score"))


@query
def reward_bands(spark, sf):
    return reward_v2(spark, sf).groupBy(scoring.band(col("reward")).alias("band")).agg(F.count("*").alias("n"), F.round(F.avg("reward"), 3).alias("mean"))


@query
def validity_score(spark, sf):
    return scoring.validity(audit_fp(spark, sf), "user_id")


@query
def consistency_score(spark, sf):
    a = stage(audit_fp(spark, sf).where("size(tables) > 0").select("stmt_id", "tables", "columns"), "audit")
    other = a.select((col("stmt_id") + 1).alias("stmt_id"), col("tables").alias("t2"), col("columns").alias("c2"))
    return a.join(other, "stmt_id").select("stmt_id", scoring.consistency(col("tables"), col("t2"), col("columns"), col("c2")).alias("score"))


# samples, splits, conversion, run statistics


@query
def stratified_quota(spark, sf):
    return sampling.quotas(src.records(spark, sf), "source_file", 1000)


@query
def sample_sizes(spark, sf):
    r = src.records(spark, sf).select("record_id", "source_file")
    parts = [("sample", sampling.sample(r, 123, "record_id")), ("stratified", sampling.stratified(r, "source_file", 500, "record_id")), ("all", sampling.sample(r, 1 << 40, "record_id"))]
    out = [d.agg(F.count_distinct("record_id").alias("n")).select(F.lit(n).alias("kind"), "n") for n, d in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def guaranteed_sample(spark, sf):
    r = src.records(spark, sf).withColumn("privileged", col("record_id") % 100 == 0)
    return sampling.guaranteed(r, "privileged", 1000, "record_id").agg(F.count("*").alias("n"), F.count_if("privileged").alias("n_privileged"))


@query
def train_val_split(spark, sf):
    return sampling.train_val(src.records(spark, sf).select("record_id"), 0.1, "record_id").groupBy("split").agg(F.count("*").alias("n"))


@query
def complexity_rotation(spark, sf):
    kind = F.element_at(F.array(F.lit("simple"), F.lit("medium"), F.lit("complex")), (F.pmod("stmt_id", F.lit(3)) + 1).cast("int"))
    return src.audit_log(spark, sf).groupBy(kind.alias("complexity")).agg(F.count("*").alias("n"))


@query
def sft_samples(spark, sf):
    c = clean.clean_records(src.records(spark, sf), src.items(spark, sf))
    r = src.records(spark, sf).drop("list_state").join(c, "record_id")
    code = F.coalesce(F.nullif(col("orm_code"), F.lit("")), col("code_value"))
    return r.where("list_state = 'LIST'").select("record_id", F.concat(F.lit("Code: "), code, F.lit("\nCaller: "), col("caller")).alias("instruction"), F.to_json("statements").alias("output"), "function_name")


@query
def rl_samples(spark, sf):
    t = item_fp(spark, sf).groupBy("record_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tables")))).alias("tables"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("columns")))).alias("columns"))
    r = src.records(spark, sf).where("orm_code <> '' and list_state <> 'LACK_INFO'").join(t, "record_id").where("size(tables) > 0 or size(columns) > 0")
    return r.select("record_id", F.lit("orm_to_sql").alias("data_source"), F.array_join("tables", ",").alias("tables"), F.array_join("columns", ",").alias("columns"))


@query
def next_version(spark, sf):
    n = F.nullif(F.regexp_extract("name", r"v(\d+)", 1), F.lit("")).cast("int")
    return src.table(spark, sf, "events").select(F.expr("'run_v' || (event_id % 37)").alias("name")).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("version"))


@query
def workflow_stats(spark, sf):
    o = src.table(spark, sf, "orders")
    steps = o.select(F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'load' WHEN 1 THEN 'clean' WHEN 2 THEN 'tag' ELSE 'export' END").alias("step_type"), col("o_custkey").alias("n_in"), F.floor(col("o_custkey") / 2).cast("long").alias("n_out"), col("o_orderkey").alias("seq"))
    return steps.groupBy("step_type").agg(F.count("*").alias("n"), F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"), F.max_by("n_out", "seq").alias("last_out"), F.round(F.sum("n_out") / F.sum("n_in"), 6).alias("retention"))


@query
def generation_stats(spark, sf):
    r = src.replies(spark, sf)
    tokens = F.when(text.strip(col("reply")) == "", 0).otherwise(F.size(F.split(text.strip(col("reply")), r"\s+")))
    return r.agg(F.count("*").alias("requests"), F.count_if(col("reply") != "").alias("succeeded"), F.sum(tokens).alias("tokens"), F.round(F.avg(tokens), 6).alias("mean_tokens"))
