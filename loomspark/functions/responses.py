"""Parsing and validation of model replies, with native expressions.

Replies are columns of an ordinary table. A parser gives an array of
statements or null; stages are tried in order with ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text
from .json_text import kind, let, whole_json
from .validation import validator  # noqa: F401  (the validators had their place here)

FENCE = text.FENCE
# Words that begin a statement line, by kind: queries and changes, definitions, rights, transactions,
# others, routines, indexes and constraints, views, the rest.
VERBS = (
    "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE",
    "CREATE", "DROP", "ALTER", "TRUNCATE", "RENAME",
    "GRANT", "REVOKE", "DENY",
    "BEGIN", "COMMIT", "ROLLBACK", "SAVEPOINT", "SET TRANSACTION",
    "USE", "SHOW", "DESCRIBE", "DESC", "EXPLAIN", "ANALYZE", "WITH", "WITH RECURSIVE", "UNION", "UNION ALL", "INTERSECT", "EXCEPT", "CALL", "EXECUTE", "PREPARE", "DEALLOCATE",
    "PROCEDURE", "FUNCTION", "TRIGGER", "EVENT",
    "INDEX", "UNIQUE", "PRIMARY", "FOREIGN", "CHECK", "DEFAULT",
    "VIEW", "MATERIALIZED VIEW",
    "LOCK", "UNLOCK", "FLUSH", "RESET", "SET", "SHUTDOWN",
)
VERB = rf"(?i)^\s*(?:{'|'.join(VERBS)})"


def nothing() -> Column:
    return F.array().cast("array<string>")


def json_items(c: Column) -> Column:
    """The items of a JSON text as strings, null if it isn't JSON: a list's elements, or else the root alone. Objects and lists stay JSON."""

    def items(root: Column) -> Column:
        found = F.coalesce(F.try_variant_get(root, "$", "array<variant>"), F.array(root))
        return F.when(root.isNotNull(), F.transform(found, lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))))

    return let(whole_json(text.strip(c)), items)


def first_json(texts: Column) -> Column:
    """The items of the first of several texts that is JSON."""
    return F.get(F.filter(F.transform(texts, json_items), lambda x: x.isNotNull()), F.lit(0))


def json_strings(c: Column) -> Column:
    """The array if the text is a JSON array of strings, else null."""
    read = F.from_json(text.strip(c), "array<string>", {"mode": "PERMISSIVE"})
    return F.when(text.strip(c).startswith("[") & whole_json(text.strip(c)).isNotNull(), read)


def fenced(c: Column, kind: str = "") -> Column:
    """Content of the first fence of a kind, empty if there is none."""
    return F.regexp_extract(c, rf"(?s){FENCE}{kind}\s*\n?(.*?){FENCE}", 1)


def bracketed(c: Column) -> Column:
    """From the first opening square bracket to the last closing one."""
    return F.regexp_extract(c, r"(?s)(\[.*\])", 1)


def statement_lines(c: Column) -> Column:
    lines = F.filter(F.transform(F.split(c, "\n"), text.strip), lambda x: x.rlike(VERB))
    return F.when(F.size(lines) > 0, lines)


def parse_reply(c: Column) -> Column:
    """A reply's statements: the whole text as JSON, json fences, any fences, what outer brackets or braces hold, statement lines, quoted texts, bracketed texts, or the text itself."""
    matches = lambda pattern: F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
    fences = F.transform(matches(rf"(?s)({FENCE}.*?{FENCE})"), lambda x: F.regexp_replace(x, rf"{FENCE}[a-zA-Z0-9_]*|`+$", ""))
    outer = F.array(bracketed(c), F.regexp_extract(c, r"(?s)(\{.*\})", 1))
    some = lambda found: F.when(F.size(found) > 0, found)
    stages = [json_items(c), first_json(matches(rf"(?is){FENCE}json\s*(.+?)\s*{FENCE}")), first_json(fences), first_json(F.filter(outer, lambda x: x != "")), statement_lines(c), some(matches(r'"([^"]*)"')), some(matches(r"\[([^\]]*)\]"))]
    return F.when(F.coalesce(text.strip(c), F.lit("")) == "", nothing()).otherwise(F.coalesce(*stages, F.array(text.strip(c))))


def statements_by_verb(c: Column) -> Column:
    """What runs from a DML verb to a semicolon."""
    return F.regexp_extract_all(c, F.lit(r"(?is)((?:SELECT|INSERT|UPDATE|DELETE)\s[^;]*;)"), F.lit(1))


# Verbs of the two simpler parsers.
QUOTED_VERBS = "SELECT|INSERT|UPDATE|DELETE|CREATE|DROP|ALTER"


def sql_response(c: Column) -> Column:
    """A reply's statements by the simpler rule: a JSON list's items or a JSON string, empty ones aside; the first bracketed part as a list; quoted texts with a verb; the text itself. Other JSON has none."""
    filled = lambda items: F.filter(F.transform(items, lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))), lambda x: ~x.isin("", "null", "false", "0", "[]", "{}"))
    listed = lambda v: F.try_variant_get(v, "$", "array<variant>")
    whole = lambda v: F.when(kind(v) == "ARRAY", filled(listed(v))).when(kind(v) == "STRING", F.filter(F.array(F.try_variant_get(v, "$", "string")), lambda x: x != "")).when(v.isNotNull(), nothing())
    inner = F.regexp_extract(c, r"(?s)(\[.*?\])", 1)
    quoted = F.regexp_extract_all(c, F.lit(rf'(?i)"([^"]*(?:{QUOTED_VERBS})[^"]*)"'), F.lit(1))
    stages = [let(whole_json(text.strip(c)), whole), let(whole_json(inner), lambda v: filled(listed(v))), F.when(F.size(quoted) > 0, quoted)]
    return F.when(F.coalesce(text.strip(c), F.lit("")) == "", nothing()).otherwise(F.coalesce(*stages, F.array(text.strip(c))))


def extracted_statements(c: Column) -> Column:
    """What prose holds: groups of variants as JSON, then statements from verb to semicolon that stand in no group; without any, the parts between semicolons that don't begin like JSON."""
    groups = F.regexp_extract_all(c, F.lit(r'(?s)(\{\s*"type"\s*:\s*"param_dependent"[^}]*"variants"\s*:\s*\[.*?\]\s*\})'), F.lit(1))
    found = F.regexp_extract_all(c, F.lit(rf"(?is)((?:{QUOTED_VERBS}).*?;)"), F.lit(1))
    variants = F.flatten(F.filter(F.transform(groups, lambda g: F.transform(F.try_variant_get(whole_json(g), "$.variants", "array<variant>"), lambda v: F.coalesce(F.try_variant_get(v, "$.sql", "string"), F.lit("")))), lambda x: x.isNotNull()))
    whole = F.concat(groups, F.filter(found, lambda s: ~F.exists(variants, lambda v: F.contains(v, s))))
    parts = F.filter(split_statements(c), lambda x: ~x.startswith("{") & ~x.startswith("["))
    return F.when(F.size(whole) > 0, whole).otherwise(parts)


def harvest(c: Column) -> Column:
    """Inline code of markdown that is SQL, without texts holding both brackets, closing semicolons off."""
    code = F.regexp_extract_all(c, F.lit(r"`([^`]+)`"), F.lit(1))
    sql = F.filter(F.transform(code, text.strip), lambda x: x.rlike(r"(?i)^(SELECT|INSERT|UPDATE|DELETE)\b") & ~(x.contains("[") & x.contains("]")))
    return F.transform(sql, lambda x: text.strip(F.regexp_replace(x, r"(;|\\G)+$", "")))


def keywords_of(c: Column, known=text.GORM_KEYWORDS) -> Column:
    """Known keywords that a reply names: those that stand in brackets as they are, or else any in any case; then quoted ones. A reply that ends in ``no`` names none."""
    low, names = F.lower(text.strip(c)), F.array(*map(F.lit, known))
    bare = lambda x: F.regexp_replace(F.regexp_replace(text.strip(x), r'^"+|"+$', ""), r"^'+|'+$", "")
    listed = F.flatten(F.transform(F.regexp_extract_all(c, F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda x: F.transform(F.split(x, ","), bare)))
    listed = F.filter(listed, lambda x: F.array_contains(names, x))
    named = F.array_compact(F.array(*[F.when(low.contains(k.lower()), k) for k in known]))
    quoted = F.filter(F.regexp_extract_all(c, F.lit(r'"([^"]+)"'), F.lit(1)), lambda x: F.array_contains(names, x))
    found = F.array_distinct(F.concat(F.when(F.size(listed) > 0, listed).otherwise(named), quoted))
    return F.when(F.coalesce(low, F.lit("")).rlike("(?s)^$|no$"), nothing()).otherwise(found)


# Parsers of replies about generation and review.


def split_statements(c: Column) -> Column:
    """The parts between semicolons, each with one at its end."""
    parts = F.filter(F.transform(F.split(c, ";"), text.strip), lambda x: x != "")
    return F.transform(parts, lambda x: F.concat(x, F.lit(";")))


def formatted(c: Column) -> Column:
    """A formatting reply: a json fence, a whole JSON list, else the text split at semicolons; so also where JSON can't be read."""
    bare = text.strip(F.coalesce(c, F.lit("")))
    fence = F.nullif(text.strip(F.regexp_extract(bare, rf"(?s){FENCE}json\s*(.*?){FENCE}", 1)), F.lit(""))
    whole = F.when(bare.startswith("[") & bare.endswith("]"), bare)
    return F.coalesce(json_items(F.coalesce(fence, whole)), split_statements(bare))


def repaired_list(c: Column) -> Column:
    """A malformed JSON list: as it is, without quotes around it, without needless escapes, else the statements that stand in it, else its parts between semicolons."""
    unquote = lambda x: F.replace(x, F.lit('\\"'), F.lit('"'))
    inner = F.when(c.startswith('"[') & c.endswith(']"'), unquote(F.substring(c, F.lit(2), F.length(c) - 2)))
    plain = unquote(F.replace(c, F.lit("\\n"), F.lit("\n")))
    found = F.regexp_extract_all(c, F.lit(r"(?is)((?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP).*?;)"), F.lit(1))
    parts = F.filter(split_statements(c), lambda x: ~x.startswith("{") & ~x.startswith("["))
    return F.coalesce(json_items(c), json_items(inner), json_items(F.when(plain != c, plain)), F.when(F.size(found) > 0, found), parts)


# Labels of an analysis report.
NO_SQL_WORDS = "不能生成SQL"
LACK_WORDS = "信息缺失"
REASON_LABELS = ("不能生成SQL的原因：", "无法生成SQL的原因：", "原因：", "NO SQL GENERATE:", "LACK INFORMATION:")
GUESS_LABELS = ("推测的SQL语句：", "推测SQL：", "SQL：", "生成的SQL：")
NO_REASON, UNREADABLE = "代码不会生成SQL", "无法解析LLM响应"


def _after(c: Column, labels: tuple[str, ...], default: str) -> Column:
    """The rest of the line behind the first label of the list that the text holds."""
    out = F.lit(default)
    for label in reversed(labels):
        out = F.when(c.contains(label), text.strip(F.regexp_extract(c, rf"\Q{label}\E([^\n]*)", 1))).otherwise(out)
    return out


def analysis_report(c: Column) -> Column:
    """A report as a struct (kind, scenario, statements): NO_SQL_GENERATE and LACK_INFORMATION come with a reason, SQL with the statements by verb."""
    up = F.upper(c)
    by_verb = F.flatten(F.array(*[F.regexp_extract_all(c, F.lit(rf"(?is)({v}\s+.*?;)"), F.lit(1)) for v in ("SELECT", "INSERT", "UPDATE", "DELETE")]))
    none, lack = up.contains("NO SQL GENERATE") | c.contains(NO_SQL_WORDS), up.contains("LACK INFORMATION") | c.contains(LACK_WORDS)
    some = F.size(by_verb) > 0
    kind = F.when(none, "NO_SQL_GENERATE").when(lack, "LACK_INFORMATION").when(some, "SQL").otherwise("NO_SQL_GENERATE")
    scenario = F.when(none, _after(c, REASON_LABELS, NO_REASON)).when(lack, F.lit(LACK_WORDS)).when(some, F.lit("")).otherwise(F.lit(UNREADABLE))
    statements = F.when(none, nothing()).when(lack, F.array(_after(c, GUESS_LABELS, ""))).otherwise(by_verb)
    return F.struct(kind.alias("kind"), scenario.alias("scenario"), statements.alias("statements"))


def verdict(c: Column) -> Column:
    """A control-flow verdict as a struct (is_correct, reason, expected_count, actual_count, n_issues, unreadable); what is missing or unreadable counts as correct."""
    v = whole_json(F.coalesce(F.nullif(F.regexp_extract(c, rf"(?s){FENCE}json\s*(\{{.*?\}})\s*{FENCE}", 1), F.lit("")), text.strip(c)))
    v = F.when(kind(v) == "OBJECT", v)
    return F.struct(
        F.coalesce(F.try_variant_get(v, "$.final_judgment.is_correct", "boolean"), F.lit(True)).alias("is_correct"),
        F.coalesce(F.try_variant_get(v, "$.final_judgment.reason", "string"), F.lit("")).alias("reason"),
        F.try_variant_get(v, "$.sql_variants_analysis.expected_count", "int").alias("expected_count"),
        F.try_variant_get(v, "$.sql_variants_analysis.actual_count", "int").alias("actual_count"),
        F.coalesce(F.size(F.try_variant_get(v, "$.sql_variants_analysis.issues", "array<variant>")), F.lit(0)).alias("n_issues"),
        v.isNull().alias("unreadable"),
    )


def regenerated(c: Column) -> Column:
    """The items of a regenerated list, from a json fence or the whole text; null if it can't be read."""
    fence = F.nullif(F.regexp_extract(c, rf"(?s){FENCE}json\s*(\[.*?\])\s*{FENCE}", 1), F.lit(""))
    return json_items(F.coalesce(fence, c))
