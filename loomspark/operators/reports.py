"""Reports in long form, all sections of one from a single pass over its rows.

A row gives a list of (section, metric, key, value); one grouping counts, adds
up and takes medians. So any number of sections costs one scan and one
shuffle of what partial aggregation leaves. Metrics whose keys are open, such as
affixes, can be cut to their most frequent keys afterwards, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.json_text import kind, whole_json

ENTRY = "array<struct<section:string,metric:string,key:string,value:double>>"


def entry(section: str, metric: str, key: Column | str = "", value: Column | float = 1.0) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), (F.lit(key) if isinstance(key, str) else key).alias("key"), value.cast("double").alias("value"))


def only(test: Column, one: Column) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), one)


def each(keys: Column, section: str, metric: str) -> Column:
    return F.transform(keys, lambda k: entry(section, metric, k))


def gathered(rows: DataFrame, entries: list[Column], lists: list[Column] = ()) -> DataFrame:
    """(section, metric, key, n, total, mean, median, least, most) of all entries of all rows."""
    whole = F.concat(F.array_compact(F.array(*entries)).cast(ENTRY), *[F.coalesce(x.cast(ENTRY), F.array().cast(ENTRY)) for x in lists])
    found = rows.select(F.explode(whole).alias("e")).select("e.*")
    v = F.col("value")
    return found.groupBy("section", "metric", "key").agg(F.count("*").alias("n"), F.sum(v).alias("total"), F.round(F.avg(v), 6).alias("mean"), F.median(v).alias("median"), F.min(v).alias("least"), F.max(v).alias("most"))


def cut(report: DataFrame, most: dict[str, int]) -> DataFrame:
    """Keeps the most frequent keys of the named metrics; equal counts by key."""
    rank = F.row_number().over(Window.partitionBy("section", "metric").orderBy(F.desc("n"), "key"))
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in most.items() for x in pair]), F.col("metric"))
    open_keys = F.col("metric").isin(*most)
    return report.where(~open_keys).unionByName(report.where(open_keys).withColumn("__k", rank).where(F.col("__k") <= limit).drop("__k"))


def with_distinct(report: DataFrame, section: str, metric: str, name: str) -> DataFrame:
    """``report`` with the number of keys of a metric in place of these keys."""
    own = (F.col("section") == section) & (F.col("metric") == metric)
    one = report.where(own).agg(F.count("*").alias("n"))
    zero = F.lit(None).cast("double")
    counted = one.select(F.lit(section).alias("section"), F.lit(name).alias("metric"), F.lit("").alias("key"), "n", F.col("n").cast("double").alias("total"), *[zero.alias(c) for c in ("mean", "median", "least", "most")])
    return report.where(~own).unionByName(counted)


def data_report(records: DataFrame) -> DataFrame:
    """All sections of the data report over records (function_name, orm_code, caller, code_value, source_file, list_state, sql_types, n_items, texts).

    ``texts``: the statements that are plain strings; ``n_items`` counts objects too.
    """
    name = text.pure_name(F.col("function_name"))
    project = F.coalesce(text.project(F.col("function_name")), F.lit("unknown"))
    code, some = F.col("orm_code"), F.col("n_items") > 0
    words = lambda w: F.array_compact(F.array(*[F.when(code.contains(k), k) for k in w]))
    fn, sq, cp, ql, pr = "functions", "statements", "code", "quality", "projects"
    entries = [
        entry("metadata", "records"),
        entry(fn, "naming", text.naming_style(name)), entry(fn, "name_length", value=F.length(name)), entry(fn, "name", name),
        only(F.length(name) > 3, entry(fn, "prefix", F.left(name, F.lit(3)))), only(F.length(name) > 3, entry(fn, "suffix", F.right(name, F.lit(3)))),
        entry(sq, "with_statements", value=some.cast("int")), entry(sq, "items", value=F.col("n_items")), entry(sq, "objects", value=F.col("n_items") - F.size("texts")),
        entry(pr, "functions", project), only(some, entry(pr, "with_statements", project)), entry(pr, "items", project, F.col("n_items")),
        entry(cp, "code_length", value=F.length(code)), entry(cp, "with_caller", value=(F.col("caller") != "").cast("int")), only(text.language(code).isNotNull(), entry(cp, "language", text.language(code))),
        *[entry(ql, "complete", f, t.cast("int")) for f, t in (("function_name", F.col("function_name") != ""), ("orm_code", code != ""), ("statements", some), ("types", F.size("sql_types") > 0), ("metadata", F.col("code_value") != ""), ("source_file", F.col("source_file") != ""))],
        entry(ql, "aligned", value=(some & (F.size("sql_types") > 0)).cast("int")), entry(ql, "name_format", value=(F.col("function_name").contains(":") & F.col("function_name").contains("/")).cast("int")),
    ]
    up = F.transform("texts", F.upper)
    per_text = lambda f: F.flatten(F.transform(up, f))
    kind = lambda s: F.when(s.contains("LEFT JOIN"), "LEFT JOIN").when(s.contains("RIGHT JOIN"), "RIGHT JOIN").when(s.contains("INNER JOIN"), "INNER JOIN").when(s.contains("JOIN"), "SIMPLE JOIN")
    hard = lambda s: F.when(text.any_of(text.COMPLEX, lambda w: s.contains(w)), "complex").otherwise("simple")
    tables = lambda s: F.concat(*[F.regexp_extract_all(s, F.lit(rf"{w}\s+(\w+)"), F.lit(1)) for w in ("FROM", "JOIN")])
    lists = [
        F.transform("texts", lambda s: entry(sq, "length", value=F.length(s))),
        F.transform(up, lambda s: entry(sq, "complexity", hard(s))),
        F.array_compact(F.transform(up, lambda s: only(kind(s).isNotNull(), entry(sq, "join", kind(s))))),
        each(per_text(lambda s: F.array_compact(F.array(*[F.when(s.contains(k), k) for k in text.ANALYSED_KEYWORDS]))), sq, "keyword"),
        each(per_text(tables), sq, "table"),
        each(words(text.ORM_WORDS), cp, "orm_word"), each(words(text.ERROR_WORDS), cp, "error_word"),
        F.transform("sql_types", lambda t: entry(pr, "type", F.concat_ws("/", project, t))),
    ]
    found = with_distinct(gathered(records, entries, lists), fn, "name", "unique_names")
    return cut(found, {"prefix": 10, "suffix": 10})


def pattern_report(results: DataFrame, top: int = 20) -> DataFrame:
    """Types, complexity, the most frequent patterns, lengths and errors of results (statements array<string>, error)."""
    s = "patterns"
    texts = F.filter("statements", lambda x: text.strip(x) != "")
    lists = [
        F.transform(texts, lambda x: entry(s, "type", text.sql_type_with_ddl(x))), F.transform(texts, lambda x: entry(s, "complexity", text.complexity(x))),
        F.transform(texts, lambda x: entry(s, "length", value=F.length(x))), each(F.flatten(F.transform(texts, text.pattern_flags)), s, "pattern"),
    ]
    return cut(gathered(results, [only(F.coalesce(F.col("error"), F.lit("")) != "", entry(s, "error", text.error_class(F.col("error"))))], lists), {"pattern": top})


def evaluation_report(samples: DataFrame, top: int = 20, examples: int = 5) -> DataFrame:
    """All parts of an evaluation's report over samples (sample_id, ok, statements, error, fps array<struct<fp,matched,sql_text>>, valid, matched).

    Patterns, coverage, quality and the first examples of each class, in long form; examples carry the sample as key and its place as value.
    """
    c, q = "coverage", "quality"
    score = F.col("ok").cast("int") + (F.size("statements") > 0).cast("int") + (F.col("valid") > 0).cast("int") + 2 * (F.col("matched") > 0).cast("int")
    band = F.when(score >= 4, "high").when(score >= 2, "medium").otherwise("low")
    lists = [
        F.transform("fps", lambda x: entry(c, "found", value=x["matched"].cast("int"))),
        F.transform(F.filter("fps", lambda x: x["matched"]), lambda x: entry(c, "fingerprint", x["fp"])),
        F.transform(F.filter("fps", lambda x: ~x["matched"]), lambda x: entry(c, "unmatched_type", text.sql_type_with_ddl(x["sql_text"]))),
    ]
    found = cut(gathered(samples, [entry(q, "score", value=score), entry(q, "scores", score.cast("string")), entry(q, "band", band)], lists), {"fingerprint": top})
    group = F.when(~F.col("ok"), "failed").when(F.col("matched") > 0, "excellent").when(F.col("valid") > 0, "good").otherwise("poor")
    grouped = samples.select(group.alias("metric"), "sample_id")
    first = None
    for g in ("failed", "excellent", "good", "poor"):
        own = grouped.where(F.col("metric") == g).orderBy("sample_id").limit(examples)
        first = own if first is None else first.unionByName(own)
    none = F.lit(None).cast("double")
    shown = first.select(F.lit("examples").alias("section"), "metric", F.col("sample_id").cast("string").alias("key"), F.lit(1).cast("long").alias("n"), F.lit(1.0).alias("total"), *[none.alias(x) for x in ("mean", "median", "least", "most")])
    return pattern_report(samples, top).unionByName(found).unionByName(shown)


def flattened(rows: DataFrame, key: str, summary: str) -> DataFrame:
    """(key, metric, value) of JSON summaries: the fields of sections as if they stood at the top; of a name that comes twice the last one counts, in the order of the text.

    A summary that is no object is the metric ``summary`` itself.
    """
    v = whole_json(F.col(summary))
    names = F.json_object_keys(F.when(kind(v) == "OBJECT", F.col(summary)))
    at = rows.select(key, v.alias("v"), F.posexplode_outer(names).alias("i", "name"))
    part = F.element_at(F.try_variant_get("v", "$", "map<string,variant>"), F.col("name"))
    inner = F.map_entries(F.try_variant_get(part, "$", "map<string,variant>"))
    alone = F.array(F.struct(F.coalesce("name", F.lit("summary")).alias("key"), F.when(F.col("name").isNull(), F.col("v")).otherwise(part).alias("value")))
    whole = at.where("name is not null or not schema_of_variant(v) like 'OBJECT%'")
    flat = whole.select(key, "i", F.explode(F.when(kind(part) == "OBJECT", inner).otherwise(alone)).alias("e"))
    shown = F.when(kind(F.col("e.value")) == "STRING", F.try_variant_get("e.value", "$", "string")).otherwise(F.to_json("e.value"))
    return flat.groupBy(key, F.col("e.key").alias("metric")).agg(F.max_by(F.struct(shown.alias("s")), F.coalesce("i", F.lit(0))).alias("s")).select(key, "metric", F.col("s.s").alias("value"))
