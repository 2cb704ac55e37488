"""Column functions over SQL text and code: normalisation, predicates, classifiers, taggers.

All are built-in expressions, so they run inside whole-stage code generation
where Spark can do so.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "`" * 3
# Keyword lists that results depend on.
GORM_KEYWORDS = ("Preload", "Transaction", "Scopes", "FindInBatches", "FirstOrInit", "Association", "Locking", "Pluck", "Callbacks", "AutoMigrate", "ForeignKey", "References", "NamedQuery", "Hooks", "NamedParameters", "save", "createorupdate")
SQL_KEYWORDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "TRUNCATE", "REPLACE", "SHOW", "DESCRIBE", "EXPLAIN", "WITH", "UNION", "HAVING", "GROUP BY", "ORDER BY", "LIMIT")
SQL_FRAGMENTS = ("FROM ", "INTO ", "SET ", "WHERE ", "VALUES")
SYSTEM_FUNCTIONS = ("last_insert_id", "version", "database", "schema", "user", "current_user", "connection_id", "row_count", "found_rows", "current_date", "current_time", "current_timestamp", "now", "sysdate", "curdate", "curtime")
STARTERS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "DROP", "TRUNCATE", "BEGIN", "COMMIT", "ROLLBACK", "SET", "SHOW", "USE", "EXPLAIN", "DESCRIBE", "DESC", "GRANT", "REVOKE", "ANALYZE")
LIKELY = (r"SELECT\s+.*?\s+FROM", r"INSERT\s+INTO", r"UPDATE\s+.*?\s+SET", r"DELETE\s+FROM", r"CREATE\s+TABLE", r"ALTER\s+TABLE", r"DROP\s+TABLE", r"JOIN\s+.*?\s+ON")
EXCLUDED = ("transaction_begin", "transaction_end", "session_setting", "show_command", "ddl_command", "empty_sql", "not_sql", "invalid_sql")
CONTROL_FLOW = ("switch", "if", "else if", "else", "case", "default")
ANALYSED_KEYWORDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "JOIN", "LEFT JOIN", "RIGHT JOIN", "INNER JOIN", "WHERE", "GROUP BY", "ORDER BY", "HAVING", "UNION", "SUBQUERY")
COMPLEX = ("JOIN", "SUBQUERY", "UNION", "GROUP BY", "HAVING")
ORM_WORDS = ("gorm", "db.", "Query", "Exec", "Raw", "Model", "Table")
ERROR_WORDS = ("error", "err", "Error", "panic", "recover")
NO_SQL = "<NO SQL GENERATE>"
LACK_INFO = "<LACK INFORMATION>"
REDUNDANT = " <REDUNDANT SQL>"
SCENARIO_RULES = {"with_first": "LIMIT 1", "with_take": "LIMIT 1", "with_last": "ORDER BY pk DESC LIMIT 1", "with_find_no_limit": "no LIMIT", "with_count": "COUNT(*)"}


def any_of(words, test) -> Column:
    return reduce(lambda a, b: a | b, [test(w) for w in words])


def strip(c: Column) -> Column:
    """Strips all white space, unlike ``trim``."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def has_cjk(c: Column) -> Column:
    return c.rlike(r"[\x{4e00}-\x{9fff}]")


def is_valid_sql(c: Column) -> Column:
    """A statement text that holds an SQL keyword or a clause fragment, in any case, not bounded by words."""
    up = F.upper(c)
    return F.coalesce((strip(c) != "") & any_of((*SQL_KEYWORDS, *SQL_FRAGMENTS), lambda w: up.contains(w)), F.lit(False))


def normalize_sql(c: Column) -> Column:
    """Comments go, white space collapses, numbers, strings, numbered aliases and limits become marks."""
    for pattern, by in (
        (r"(?m)--.*?$", ""),
        (r"(?s)/\*.*?\*/", ""),
        (r"\s+", " "),
        (r"^ | $", ""),
        (r"([`\"\s])t\d+([`\"\s])", "$1t_alias$2"),
        (r"=\s*\d+", "= N"),
        (r"(?i)IN\s*\(\s*\d+(\s*,\s*\d+)*\s*\)", "IN (N)"),
        (r"'[^']*'", "'S'"),
        (r'"[^"]*"', '"S"'),
        (r"(?i)LIMIT\s+\d+", "LIMIT N"),
    ):
        c = F.regexp_replace(c, pattern, by)
    return c


def system_function(c: Column) -> Column:
    """Name of the function of ``SELECT f()`` without FROM or WHERE, else null."""
    low = strip(F.lower(c))
    name = F.regexp_extract(low, r"select\s+(\w+)\s*\(\s*\)", 1)
    return F.when(low.startswith("select ") & ~low.contains("from") & ~low.contains("where") & name.isin(*SYSTEM_FUNCTIONS), name)


def looks_like_sql(c: Column) -> Column:
    first = F.upper(F.regexp_extract(c, r"^\s*(\S+)", 1))
    return F.coalesce(first.isin(*STARTERS) | any_of(LIKELY, lambda p: c.rlike("(?i)" + p)), F.lit(False))


def class_label(raw: Column, normal: Column) -> Column:
    """The fingerprint of statements that need no parser; null for the others."""
    up = F.upper(strip(normal))
    name = system_function(raw)
    return (
        F.when(name.isNotNull(), F.concat(F.lit("system_function_"), name))
        .when(up.isin("BEGIN", "BEGIN;", "START TRANSACTION", "START TRANSACTION;"), "transaction_begin")
        .when(up.isin("COMMIT", "COMMIT;", "ROLLBACK", "ROLLBACK;"), "transaction_end")
        .when(up.startswith("SET "), "session_setting")
        .when(up.startswith("SHOW "), "show_command")
        .when(any_of(("CREATE ", "ALTER ", "DROP ", "TRUNCATE ", "RENAME "), lambda w: up.startswith(w)), "ddl_command")
        .when(~looks_like_sql(normal), "not_sql")
    )


def is_excluded(fp: Column) -> Column:
    return fp.isin(*EXCLUDED)


def is_transaction_wrapper(c: Column) -> Column:
    low = F.lower(c)
    return (low.contains("begin") | low.contains("start transaction")) & (low.contains("commit") | low.contains("rollback"))


def without_comments(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?s)/\*.*?\*/", ""), r"(?m)--.*?$", ""))


def _prefixed(c: Column, classes) -> Column:
    out = None
    for name, starts in classes:
        test = any_of(starts, lambda s: c.startswith(s))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


DML = tuple((w, (w,)) for w in ("SELECT", "INSERT", "UPDATE", "DELETE"))


def classify_sql(c: Column) -> Column:
    return _prefixed(F.upper(strip(c)), DML).otherwise("OTHER")


def sql_type_with_ddl(c: Column) -> Column:
    return _prefixed(F.upper(without_comments(c)), (*DML, ("DDL", ("CREATE", "ALTER", "DROP")))).otherwise("OTHER")


def sql_type_with_transactions(c: Column) -> Column:
    clean = without_comments(c)
    return _prefixed(F.upper(clean), (*DML, ("TRANSACTION", ("ROLLBACK", "SAVEPOINT")))).when(F.lower(clean).contains("information_schema"), "SCHEMA_INFO").otherwise("OTHER")


def complexity_score(c: Column) -> Column:
    up = F.upper(c)
    count = lambda p: F.regexp_count(up, F.lit(p))
    return 2 * count(r"\bJOIN\b") + count(r"[()]") + count(r"\bWHERE\b") + count(r"\bHAVING\b")


def complexity(c: Column) -> Column:
    score = complexity_score(c)
    return F.when(score <= 2, "SIMPLE").when(score <= 8, "MEDIUM").otherwise("COMPLEX")


def pattern_flags(c: Column) -> Column:
    up = F.upper(c)
    tests = [(f"HAS_{w.replace(' ', '_')}", up.contains(w)) for w in ("JOIN", "WHERE", "GROUP BY", "ORDER BY", "LIMIT", "UNION")]
    tests += [("HAS_COUNT", up.rlike(r"\bCOUNT\s*\(")), ("HAS_AGGREGATION", up.rlike(r"\b(SUM|AVG|MIN|MAX)\s*\(")), ("HAS_PARAMETERS", c.contains("?") | c.contains(":"))]
    return F.array_compact(F.array(*[F.when(test, name) for name, test in tests]))


def error_class(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.contains("json"), "JSON_PARSE_ERROR").when(low.contains("sql"), "SQL_ERROR").when(low.contains("timeout"), "TIMEOUT_ERROR").when(low.contains("memory"), "MEMORY_ERROR").otherwise("OTHER_ERROR")


def matched_keywords(code: Column, orm: Column, keywords=GORM_KEYWORDS) -> Column:
    """Sorted array of the keywords that either text holds, case-sensitive."""
    return F.array_sort(F.array_compact(F.array(*[F.when(code.contains(k) | orm.contains(k), k) for k in keywords])))


def has_control_flow(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(any_of(CONTROL_FLOW, lambda w: low.contains(w)), F.lit(False))


def pure_name(c: Column) -> Column:
    """What stands behind the last colon, or else the last slash."""
    return F.when(c.contains(":"), F.element_at(F.split(c, ":"), -1)).otherwise(F.element_at(F.split(c, "/"), -1))


def naming_style(name: Column) -> Column:
    return (
        F.when(name.rlike("^[a-z][a-zA-Z0-9]*$"), "camelCase")
        .when(name.rlike("^[A-Z][a-zA-Z0-9]*$"), "PascalCase")
        .when(name.contains("_") & ~name.contains("-"), "snake_case")
        .when(name.contains("-") & ~name.contains("_"), "kebab-case")
        .otherwise("mixed")
    )


def project(function_name: Column) -> Column:
    """Seventh part of the path, up to a double underscore; null with six parts or fewer."""
    parts = F.split(function_name, "/")
    return F.when(F.size(parts) > 6, F.element_at(F.split(F.element_at(parts, 7), "__"), 1))


def language(code: Column) -> Column:
    return F.when(code.contains("func ") & ~code.contains("import"), "Go").when(code.contains("def "), "Python").when(code.contains("function") | code.contains("=>"), "JavaScript")


# Signs of a statement with gaps, and the mark that it gets.
GAPS = ("...", "[其他", "其他]")
INCOMPLETE = "不完整SQL语句: "


def mark_incomplete(c: Column) -> Column:
    return F.when(any_of(GAPS, lambda w: c.contains(w)), F.concat(F.lit(INCOMPLETE), c)).otherwise(c)


def comparable(c: Column) -> Column:
    """Text by which two statements are equal: white space collapsed, closing semicolons off, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip(F.regexp_replace(c, r"\s+", " ")), ";+$", ""), r"\s+$", ""))


# Verbs that begin a statement of an instruction.
SIMPLE_VERBS = ("SELECT", "SHOW", "EXPLAIN", "SET", "ANALYZE", "CREATE", "ALTER", "DROP", "INSERT", "UPDATE", "DELETE", "DESCRIBE", "USE")


def is_simple_sql(c: Column) -> Column:
    """A known verb in front, balanced parentheses, an even number of single quotes."""
    up = F.upper(strip(c))
    n = lambda p: F.regexp_count(c, F.lit(p))
    return any_of(SIMPLE_VERBS, lambda w: up.startswith(w)) & (n(r"\(") == n(r"\)")) & (n("'") % 2 == 0)


def same_variants(kind: Column, statements: Column, other_kind: Column, other_statements: Column) -> Column:
    """Two groups of variants count as equal if type and number agree and any statement is in both, by ``comparable``."""
    plain = lambda x: F.transform(x, comparable)
    return kind.eqNullSafe(other_kind) & (F.size(statements) == F.size(other_statements)) & F.arrays_overlap(plain(statements), plain(other_statements))
