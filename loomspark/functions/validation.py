"""Validators of replies: ordered rules compiled to one expression that gives the first broken one.

A validator takes a reply column and gives an error, a struct (code, detail)
that is null for a good reply. ``validate`` adds the verdict. Details are the
missing fields, or the place of a bad item: ``2`` in a list, ``2.0`` of its first variant.
A rule that can't be decided, as of a value of another kind, counts as broken. A null reply is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text
from .json_text import body, items_at, keys, kind, let, missing, string_at, whole_json

ERROR = "struct<code:string,detail:string>"
# Shapes of fenced values, types of items, words of verdicts.
OBJECT, ARRAY, EITHER = r"\{.*?\}", r"\[.*?\]", r"\[.*?\]|\{.*?\}"
DEPENDENT, EDGE = "param_dependent", ("LACK_INFORMATION", "NO_SQL_GENERATE")
YES_NO = ("是", "yes", "true", "否", "no", "false")
PRECHECK = ("yes", "no", "will", "generate", "sql")
PRECHECK_EXACT = ("yes", "no", "true", "false", "1", "0")
REDUNDANT_WORDS = ("是，冗余", "否，不冗余")
SYNTHETIC = {"orm": ("scenario", "code_key", "code_value", "sql_pattern_cnt"), "caller": ("code_key", "code_value"), "meta": ("code_key", "code_value")}


def none() -> Column:
    return F.lit(None).cast(ERROR)


def bad(code: str, broken: Column, detail: Column | None = None) -> Column:
    """The error if the rule is broken, or if it can't be decided."""
    found = F.struct(F.lit(code).alias("code"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))
    return F.when(F.coalesce(broken, F.lit(True)), found.cast(ERROR))


def each(items: Column, rules: Callable[[Column, Column], Column]) -> Column:
    """The first item's error."""
    return F.get(F.filter(F.transform(items, rules), lambda e: e.isNotNull()), F.lit(0))


def not_kind(code: str, v: Column, want: str, path: str = "$") -> Column:
    return bad(code, kind(v, path) != want)


def lacks(v: Column, *fields: str, at: Column | None = None, code: str = "missing_fields") -> Column:
    gone = missing(v, *fields)
    named = F.array_join(gone, ",")
    return bad(code, F.size(gone) > 0, named if at is None else F.concat(at.cast("string"), F.lit(":"), named))


def lists(v: Column, *fields: str, at: Column | None = None) -> list[Column]:
    return [bad("not_a_list_field", kind(v, f"$.{f}") != "ARRAY", F.lit(f) if at is None else F.concat(at.cast("string"), F.lit(":"), F.lit(f))) for f in fields]


def any_in(c: Column, words: tuple[str, ...]) -> Column:
    return text.any_of(words, lambda w: c.contains(w))


def lowered(c: Column) -> Column:
    return F.lower(text.strip(c))


def json_error(c: Column) -> Column:
    """One JSON value, or an object in a json fence, or else an object from the first brace to the last."""
    fence, brace = F.regexp_extract(c, rf"(?s){text.FENCE}json\s*({OBJECT})\s*{text.FENCE}", 1), F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    found = F.when(fence != "", bad("bad_fence", whole_json(fence).isNull())).when(brace != "", bad("bad_object", whole_json(brace).isNull())).otherwise(bad("no_json", F.lit(True)))
    return F.when(whole_json(text.strip(c)).isNull(), found)


def in_body(c: Column, shape: str, rules: Callable[[Column], Column], json_first: bool = True) -> Column:
    """The shared JSON check, then the rules of the fenced or whole value."""
    unfenced = c.contains(f"{text.FENCE}json") & (F.regexp_extract(c, rf"(?s){text.FENCE}json\s*({shape})\s*{text.FENCE}", 1) == "")
    inner = let(body(c, shape), lambda v: F.coalesce(bad("unreadable", v.isNull()), rules(v)))
    return F.coalesce(json_error(c) if json_first else none(), bad("no_fenced_value", unfenced), inner)


def _structured(c: Column, fields: tuple[str, ...] = ("result",)) -> Column:
    """In an object fields are keys, in a list items, in a string parts; other values can't be asked."""

    def rules(v: Column) -> Column:
        wanted = F.array(*map(F.lit, fields))
        in_list = F.transform(items_at(v), lambda x: string_at(x))
        gone = F.when(kind(v) == "OBJECT", missing(v, *fields)).when(kind(v) == "ARRAY", F.array_except(wanted, in_list)).when(kind(v) == "STRING", F.filter(wanted, lambda f: ~F.contains(string_at(v), f)))
        return F.coalesce(bad("unreadable", gone.isNull()), bad("missing_fields", F.size(gone) > 0, F.array_join(gone, ",")))

    return in_body(c, OBJECT, rules)


def _verdict(c: Column) -> Column:
    low = lowered(c)
    return F.coalesce(bad("empty", c == ""), bad("no_verdict", ~(low.startswith("是") | low.startswith("否") | c.contains("，") | c.contains(","))))


def _keyword(c: Column) -> Column:
    bare = text.strip(c)

    def rules(v: Column) -> Column:
        return F.coalesce(bad("unreadable", v.isNull()), bad("not_strings", (kind(v) != "ARRAY") | F.exists(items_at(v), lambda x: kind(x) != "STRING")))

    return F.coalesce(bad("empty", c == ""), F.when(~bare.isin("No", '"No"', "'No'"), let(whole_json(bare), rules)))


def _or_words(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda c: F.when(json_error(c).isNotNull(), bad("no_verdict", ~any_in(lowered(c), words)))


def _variants(item: Column, i: Column, closed: bool) -> Column:
    """Variants are objects with a scenario and a statement, which ends in a semicolon if ``closed``."""
    at = lambda j: F.concat_ws(".", i.cast("string"), j.cast("string"))
    listed = kind(item, "$.variants")

    def rules(w: Column, j: Column) -> Column:
        own = [bad("variant_not_an_object", kind(w) != "OBJECT", at(j)), bad("variant_fields", F.size(missing(w, "scenario", "sql")) > 0, at(j))]
        ends = [bad("unreadable", string_at(w, "$.sql").isNull()), bad("variant_no_semicolon", ~F.endswith(text.strip(string_at(w, "$.sql")), F.lit(";")), at(j))] if closed else []
        return F.coalesce(*own, *ends)

    # no variants at all are no error
    return F.coalesce(bad("variants_not_a_list", F.array_contains(keys(item), "variants") & (listed != "ARRAY"), i), each(items_at(item, "$.variants"), rules))


def _statements(edge: bool) -> Callable[[Column], Column]:
    def item(v: Column, i: Column) -> Column:
        own = string_at(v, "$.type")
        typed = F.when(F.coalesce(own == DEPENDENT, F.lit(False)), _variants(v, i, True))
        if edge:
            typed = typed.when(F.coalesce(own.isin(*EDGE), F.lit(False)), _variants(v, i, False))
        return (
            F.when(kind(v) == "STRING", bad("no_semicolon", ~F.endswith(text.strip(string_at(v)), F.lit(";")), i))
            .when(kind(v) == "OBJECT", typed.otherwise(bad("wrong_type", F.lit(True), i)))
            .otherwise(bad("wrong_item", F.lit(True), i))
        )

    return lambda c: in_body(c, ARRAY, lambda v: F.coalesce(not_kind("not_a_list", v, "ARRAY"), each(items_at(v), item)))


def _fix_review(c: Column) -> Column:
    there = lambda v: F.array_contains(keys(v), "replacement")
    return in_body(c, OBJECT, lambda v: F.coalesce(not_kind("not_an_object", v, "OBJECT"), lacks(v, "accepted"), not_kind("accepted_not_boolean", v, "BOOLEAN", "$.accepted"), bad("replacement_not_a_string", there(v) & (kind(v, "$.replacement") != "STRING"))))


def _precheck(c: Column) -> Column:
    low = lowered(c)
    return F.coalesce(bad("empty", c == ""), bad("no_verdict", ~(low.isin(*PRECHECK_EXACT) | any_in(low, PRECHECK))))


def _boolean(c: Column, expected: tuple[str, ...] = ()) -> Column:
    return F.coalesce(bad("empty", c == ""), bad("no_verdict", ~any_in(lowered(c), (*YES_NO, *map(str.lower, expected)))))


def synthetic_rules(v: Column, data: str) -> Column:
    """Of generated data: its one object or the first of its list; of metadata every item."""
    fields = SYNTHETIC[data]
    if data == "meta":
        return F.coalesce(not_kind("not_a_list", v, "ARRAY"), each(items_at(v), lambda x, i: F.coalesce(bad("item_not_an_object", kind(x) != "OBJECT", i), bad("item_fields", F.size(missing(x, *fields)) > 0, i))))
    first = F.when(kind(v) == "ARRAY", F.get(items_at(v), F.lit(0))).otherwise(v)
    none_there = (kind(v) == "ARRAY") & (F.size(items_at(v)) == 0)
    return F.coalesce(bad("empty_list", none_there), bad("not_an_object", kind(first) != "OBJECT"), lacks(first, *fields))


def _synthetic(c: Column, data: str = "orm") -> Column:
    return in_body(c, EITHER, lambda v: synthetic_rules(v, data), json_first=False)


def _whole(data: str) -> Callable[[Column], Column]:
    return lambda c: let(whole_json(text.strip(c)), lambda v: F.coalesce(bad("unreadable", v.isNull()), synthetic_rules(v, data)))


def _select(v: Column, path: str, at: Column | None = None) -> list[Column]:
    q = string_at(v, path)
    return [bad("unreadable", q.isNull()), bad("not_a_select", ~lowered(q).startswith("select"), at)]


def _reverse_sql(c: Column) -> Column:
    return in_body(c, OBJECT, lambda v: F.coalesce(not_kind("not_an_object", v, "OBJECT"), lacks(v, "query", "table", "fields", "conditions"), *lists(v, "fields", "conditions"), *_select(v, "$.query")))


def _reverse_variants(c: Column) -> Column:
    def item(v: Column, i: Column) -> Column:
        blank = lambda f: bad("blank_field", (kind(v, f"$.{f}") != "STRING") | (text.strip(string_at(v, f"$.{f}")) == ""), F.concat(i.cast("string"), F.lit(f":{f}")))
        return F.coalesce(bad("item_not_an_object", kind(v) != "OBJECT", i), lacks(v, "query", "table", "fields", "conditions", "branch", "description", at=i), *lists(v, "fields", "conditions", at=i), blank("branch"), blank("description"), *_select(v, "$.query", i))

    return in_body(c, ARRAY, lambda v: F.coalesce(not_kind("not_a_list", v, "ARRAY"), each(items_at(v), item)))


def _go(v: Column) -> list[Column]:
    code = string_at(v, "$.code")
    return [bad("unreadable", code.isNull()), bad("empty_code", text.strip(code) == ""), bad("not_go", ~(F.lower(code).contains("func") & F.lower(code).contains("return")))]


def _reverse_code(fields: tuple[str, ...], listed: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda c: in_body(c, OBJECT, lambda v: F.coalesce(not_kind("not_an_object", v, "OBJECT"), lacks(v, *fields), *lists(v, *listed), *_go(v)))


def output_format(c: Column) -> Column:
    """A statement list, one item of it, or plain text: strings, and objects of known types whose variants have a scenario and a statement, empty only in edge cases."""

    def variant(w: Column, j: Column, i: Column, own: Column) -> Column:
        at = F.concat_ws(".", i, j.cast("string"))
        sql = string_at(w, "$.sql")
        return F.coalesce(
            bad("variant_not_an_object", kind(w) != "OBJECT", at),
            bad("variant_no_scenario", ~F.array_contains(keys(w), "scenario"), at),
            bad("variant_no_sql", ~F.array_contains(keys(w), "sql"), at),
            bad("variant_sql_not_a_string", own.isin(*EDGE) & sql.isNull(), at),
            bad("variant_empty_sql", (own == DEPENDENT) & (F.coalesce(sql, F.lit("")) == ""), at),
        )

    def item(v: Column, i: Column) -> Column:
        own = string_at(v, "$.type")
        rules = F.coalesce(
            lacks(v, "type", at=i), bad("wrong_type", ~own.isin(DEPENDENT, *EDGE), i), lacks(v, "variants", at=i), bad("variants_not_a_list", kind(v, "$.variants") != "ARRAY", i),
            each(items_at(v, "$.variants"), lambda w, j: variant(w, j, i, own)),
        )
        return F.when(kind(v) == "STRING", none()).when(kind(v) == "OBJECT", rules).otherwise(bad("wrong_item", F.lit(True), i))

    def rules(v: Column) -> Column:
        return (
            F.when(v.isNull(), bad("empty", text.strip(c) == ""))
            .when(kind(v) == "ARRAY", each(items_at(v), lambda x, i: item(x, i.cast("string"))))
            .when(kind(v) == "OBJECT", item(v, F.lit("")))
            .when(kind(v) == "STRING", bad("empty", text.strip(string_at(v)) == ""))
            .otherwise(bad("wrong_item", F.lit(True)))
        )

    return let(whole_json(text.strip(c)), rules)


# Fields of generated cases and their parts.
CASE = ("scenario", "base_sql", "orm_code", "caller_code")
SQL_FIELDS = ("query", "table", "fields", "conditions")
MAPPING_FIELDS = ("method_name", "entity_name", "table_name", "fields", "conditions")


def _part(v: Column, path: str, fields: tuple[str, ...], code: str) -> Column:
    """A part of a case has the fields; a text counts as having what it contains, as a test for membership would."""
    own = F.try_variant_get(v, path, "variant")
    wanted = F.array(*map(F.lit, fields))
    gone = F.when(kind(own) == "OBJECT", missing(own, *fields)).when(kind(own) == "STRING", F.filter(wanted, lambda f: ~F.contains(string_at(own), f))).when(kind(own) == "ARRAY", F.array_except(wanted, F.transform(items_at(own), lambda x: string_at(x))))
    return F.coalesce(bad("unreadable", gone.isNull()), bad(code, F.size(gone) > 0, F.array_join(gone, ",")))


def _whole_object(rules: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: let(whole_json(text.strip(c)), lambda v: F.coalesce(bad("unreadable", v.isNull()), not_kind("not_an_object", v, "OBJECT"), rules(v)))


def _select_from(v: Column) -> list[Column]:
    """A statement has select and from, and a letter or digit in the 20 characters from there on."""
    low = F.lower(string_at(v, "$.query"))
    after = F.substring(text.strip(F.substring(low, F.instr(low, F.lit("from")), F.length(low))), 1, 20)
    return [bad("unreadable", low.isNull()), bad("not_sql", ~(low.contains("select") & low.contains("from")) | ~after.rlike(r"[\p{L}\p{N}]"))]


def _code_of(v: Column) -> list[Column]:
    own = string_at(v, "$.code")
    return [bad("unreadable", own.isNull()), bad("empty_code", text.strip(own) == "")]


VALIDATORS: dict[str, Callable[..., Column]] = {
    "json": json_error,
    "boolean": _boolean,
    "structured": _structured,
    "list": lambda c: in_body(c, ARRAY, lambda v: not_kind("not_a_list", v, "ARRAY")),
    "completeness": _verdict,
    "correctness": _verdict,
    "keyword": _keyword,
    "redundant": _or_words(REDUNDANT_WORDS),
    "control_flow": _or_words(("合理",)),
    "regeneration": _statements(False),
    "sql_generation": _statements(True),
    "fix_review": _fix_review,
    "precheck": _precheck,
    "orm": _whole("orm"),
    "caller": _whole("caller"),
    "meta": _whole("meta"),
    "synthetic": _synthetic,
    "reverse_sql": _reverse_sql,
    "reverse_variants": _reverse_variants,
    "reverse_orm": _reverse_code(("method_name", "code", "parameters", "return_type", "table", "fields", "conditions"), ("parameters", "fields", "conditions")),
    "reverse_caller": _reverse_code(("method_name", "code", "parameters", "return_type"), ("parameters",)),
    "output_format": output_format,
    "case": _whole_object(lambda v: F.coalesce(lacks(v, *CASE), _part(v, "$.base_sql", SQL_FIELDS, "sql_fields"), _part(v, "$.orm_code", MAPPING_FIELDS, "orm_fields"))),
    "sql_data": _whole_object(lambda v: F.coalesce(lacks(v, *SQL_FIELDS), *lists(v, "fields", "conditions"), *_select_from(v))),
    "orm_data": _whole_object(lambda v: F.coalesce(lacks(v, "method_name", "code", "parameters", "return_type", "table", "fields", "conditions"), *lists(v, "fields", "conditions", "parameters"), *_code_of(v))),
    "caller_data": _whole_object(lambda v: F.coalesce(lacks(v, "method_name", "parameters", "code", "return_type"), *lists(v, "parameters"), *_code_of(v))),
}
#: The longer names under which callers may ask for a validator.
ALIASES = {
    "sql_completeness": "completeness", "sql_correctness": "correctness", "keyword_extraction": "keyword", "redundant_sql_validation": "redundant", "control_flow_validation": "control_flow",
    "control_flow_sql_regeneration": "regeneration", "synthetic_data": "synthetic", "reverse_sql_variants": "reverse_variants",
}


def check_of(name: str) -> Callable[..., Column]:
    name = ALIASES.get(name, name)
    if name not in VALIDATORS:
        raise ValueError(f"unknown validator {name!r}")
    return VALIDATORS[name]


def validate(name: str, c: Column, **options) -> Column:
    """A struct (valid, code, detail); code and detail tell the first broken rule and are null for a good reply."""
    return let(check_of(name)(F.coalesce(c, F.lit("")), **options), lambda e: F.struct(e.isNull().alias("valid"), e["code"].alias("code"), e["detail"].alias("detail")))


def validator(name: str, **options) -> Callable[[Column], Column]:
    """reply -> boolean column."""
    check = check_of(name)
    return lambda c: check(F.coalesce(c, F.lit("")), **options).isNull()
