"""Parsers that built-in expressions can't say: Arrow-batched, over any text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .responses import VERB, VERBS

VERB_LINE = re.compile(VERB)
VERB_FIRST = VERB_ANYWHERE = re.compile("|".join(VERBS), re.I)
TEXTS = T.ArrayType(T.StringType())


def clean_code(code: str | None) -> str:
    """Go text without its package line, imports, struct types and TableName methods; braces tell where a part ends."""
    out, depth, skip = [], 0, ""
    for line in (code or "").split("\n"):
        bare = line.strip()
        if skip == "import":
            skip = "" if bare.startswith(")") else skip
            continue
        if skip == "braces":
            depth += line.count("{") - line.count("}")
            skip = "" if depth <= 0 else skip
            continue
        if bare.startswith("package "):
            continue
        if bare.startswith("import"):
            skip = "import" if bare.replace(" ", "").startswith("import(") and ")" not in bare else ""
            continue
        if re.match(r"type\s+\w+\s+struct\b", bare) or re.match(r"func\s*\([^)]*\)\s*TableName\s*\(", bare):
            depth = line.count("{") - line.count("}")
            skip = "braces" if depth > 0 else ""
            continue
        out.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


def bracketed_json(reply: str | None) -> str:
    """The first balanced JSON value of a reply, strings respected; empty if there is none."""
    text = re.sub(r"^```\w*\s*|\s*```$", "", (reply or "").strip())
    for at, c in enumerate(text):
        if c not in "[{":
            continue
        stack, quoted, escaped = [], False, False
        for i in range(at, len(text)):
            ch = text[i]
            if quoted:
                quoted = escaped or ch != '"'
                escaped = ch == "\\" and not escaped
            elif ch == '"':
                quoted = True
            elif ch in "[{":
                stack.append("]" if ch == "[" else "}")
            elif stack and ch == stack[-1]:
                stack.pop()
                if not stack:
                    return text[at : i + 1]
            elif ch in "]}":
                break
    return ""


CLOSING = {"[": "]", "{": "}"}


def balanced_part(reply: str | None) -> str:
    """From the first square bracket, or the first brace if there is none, to where all that was opened is closed; empty if it never is. Strings aren't told apart."""
    text = reply or ""
    at = text.find("[") if "[" in text else text.find("{")
    awaited: list[str] = []
    for i in range(max(at, 0), len(text)):
        if text[i] in CLOSING:
            awaited.append(CLOSING[text[i]])
        elif awaited and text[i] == awaited[-1]:
            awaited.pop()
            if not awaited:
                return text[at : i + 1]
    return ""


def statements_in(value) -> list[str]:
    """Statements anywhere inside a JSON value; the rule of ``operators.nested`` for single values, for use as an SQL function."""
    if isinstance(value, list):
        return [s for v in value for s in statements_in(v)]
    if isinstance(value, dict):
        if value.get("type") == "param_dependent" and "variants" in value:
            return [s for v in value["variants"] or [] if isinstance(v, dict) for s in statements_in(v.get("sql"))]
        return statements_in(value["sql"]) if "sql" in value else [s for v in value.values() for s in statements_in(v)]
    if not isinstance(value, str) or not value.strip():
        return []
    try:
        return statements_in(json.loads(value))
    except ValueError:
        pass
    if VERB_FIRST.match(value):
        return [value.strip()]
    if not VERB_ANYWHERE.search(value):
        return []
    return [x.strip() for x in value.split("\n") if VERB_LINE.match(x)] or [value.strip()]


@F.pandas_udf(T.StringType())
def cleaned(codes: pd.Series) -> pd.Series:
    return codes.map(clean_code)


@F.pandas_udf(T.StringType())
def balanced(replies: pd.Series) -> pd.Series:
    return replies.map(bracketed_json)


@F.pandas_udf(TEXTS)
def extracted(replies: pd.Series) -> pd.Series:
    """Statements of a text, found recursively in its JSON or in its lines."""
    return replies.map(statements_in)


@F.pandas_udf(T.StringType())
def first_balanced(replies: pd.Series) -> pd.Series:
    return replies.map(balanced_part)
