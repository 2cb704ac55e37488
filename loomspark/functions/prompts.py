"""Prompts and layouts: our own templates with placeholders filled by native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEMPLATES = {
    "generate": "List every SQL statement that the method below can emit, as a JSON array of strings.\n\nMethod:\n{code}\n\nCaller:\n{caller}\n\nContext:\n{metadata}\n",
    "precheck": "Does the method below emit any SQL? Answer yes or no.\n\n{code}\n",
    "completeness": "Is the information below enough to write all SQL statements? Begin with yes or no, then a comma and the reason.\n\n{code}\n{metadata}\n",
    "correctness": "Are the statements below what the method emits? Begin with yes or no, then a comma and the reason.\n\n{code}\n{statements}\n",
    "control_flow": "Do the statements below fit the branches of the method? Answer as JSON.\n\n{code}\n{statements}\n",
}
POSITION_FIELDS = ("code_file", "code_start_line", "code_end_line", "code_label", "code_type", "code_version", "source_file")


def fill(name: str, **values: Column) -> Column:
    """A template with its placeholders replaced; those that aren't given stay."""
    out = F.lit(TEMPLATES[name])
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v, F.lit("")))
    return out


def metadata_layout(metadata: Column, layout: str = "plain") -> Column:
    """An array of (code_key, code_value, code_file, ...) as text."""
    shapes = {
        "plain": lambda m: F.concat_ws("\n", m["code_key"], m["code_value"]),
        "numbered": lambda m, i: F.concat(i + 1, F.lit(". "), m["code_key"], F.lit(": "), m["code_value"]),
        "files": lambda m: F.concat(F.lit("// "), m["code_file"], F.lit("\n"), m["code_value"]),
        "fenced": lambda m: F.concat(F.lit("```\n"), m["code_value"], F.lit("\n```")),
        "values": lambda m: m["code_value"],
    }
    return F.array_join(F.transform(metadata, shapes[layout]), "\n\n")


def numbered_variants(statements: Column) -> Column:
    return F.array_join(F.transform(statements, lambda s, i: F.concat(i + 1, F.lit(". "), s)), "\n")


def case_key(scenario: Column, complexity: Column, number: Column) -> Column:
    return F.concat_ws("_", F.translate(F.lower(scenario), " +-", "___"), complexity, F.lpad(number.cast("string"), 4, "0"))


def without_positions(metadata: Column) -> Column:
    """Metadata structs reduced to key and value."""
    return F.transform(metadata, lambda m: F.struct(m["code_key"].alias("code_key"), m["code_value"].alias("code_value")))


def valid_pack(pack: Column) -> Column:
    """Six required fields, callers whose first has key and value, listed metadata."""
    first = F.get(pack["callers"], F.lit(0))
    has = [pack[f].isNotNull() for f in ("scenario", "code_key", "code_value", "sql_pattern_cnt", "callers", "code_meta_data")]
    ok = F.lit(True)
    for h in has:
        ok = ok & h
    return F.coalesce(ok & (F.size(pack["callers"]) > 0) & first["code_key"].isNotNull() & first["code_value"].isNotNull(), F.lit(False))
