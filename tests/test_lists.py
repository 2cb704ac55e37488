"""Raw lists, nested values and converters against plain versions."""

import json
import random

from pyspark.sql import functions as F

from loomspark.functions import code, rawlists, validation
from loomspark.operators import convert, nested
from loomspark.sources import records, replies


def value(rng, depth):
    kind = rng.randrange(8 if depth else 4)
    if kind < 3:
        return rng.choice(["SELECT 1;", "hello", " DELETE x", "note\nUPDATE y", "", "5", '["INSERT z"]', '{"sql": "DROP w"}', '"SELECT q"', "null"])
    if kind == 3:
        return rng.choice([None, 3, 2.5, True])
    if kind < 6:
        return [value(rng, depth - 1) for _ in range(rng.randrange(4))]
    if kind == 6:
        return {k: value(rng, depth - 1) for k in rng.sample(["z", "a", "sql", "type", "m"], rng.randrange(4))}
    return {"type": "param_dependent", "variants": [{"sql": value(rng, depth - 1)} if rng.random() < 0.8 else {"scenario": "s"} for _ in range(rng.randrange(3))]}


def test_rounds_give_what_the_recursion_gives(spark):
    rng = random.Random(4)
    values = [value(rng, 4) for _ in range(250)]
    texts = [json.dumps(v) for v in values] + ["plain SELECT", "[broken", " ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    got = {r.k: r.statements for r in nested.gathered(nested.statements(df, ["k"], "t"), df, ["k"]).collect()}
    assert got == {k: code.statements_in(t) for k, t in enumerate(texts)}


def test_balanced_part():
    assert code.balanced_part('a {"x": [1]} b') == "[1]"
    assert code.balanced_part("a {1} b") == "{1}" and code.balanced_part("[1} 2] x") == "[1} 2]" and code.balanced_part("[1") == "" and code.balanced_part(None) == "" and code.balanced_part("none") == ""


def test_every_validator_has_three_errors_or_all_it_knows():
    codes = {}
    for name, _, c, _ in replies.VERDICTS:
        codes.setdefault(name, set()).add(c)
    assert set(codes) == set(validation.VALIDATORS)
    few = {n for n, c in codes.items() if len(c - {None}) < 3}
    # these know no more than that: empty, and without a verdict
    assert few <= {"boolean", "completeness", "correctness", "precheck", "redundant", "control_flow"}, few


def test_validator_names(spark):
    assert validation.check_of("sql_completeness") is validation.check_of("completeness")
    try:
        validation.check_of("none")
    except ValueError as e:
        assert "none" in str(e)
    row = spark.createDataFrame([("maybe",), (None,)], "r string").select(validation.validate("boolean", F.col("r"), expected=("MAYBE",)).alias("v")).collect()
    assert [tuple(r.v) for r in row] == [(True, None, None), (False, "empty", "")]


def test_fixed_lists_keep_what_they_dont_know():
    assert rawlists.fixed(5, {"a"}, ["b"]) == 5
    assert rawlists.fixed({"type": "param_dependent", "variants": None}, set(), ["b"]) == {"type": "param_dependent", "variants": [{"scenario": rawlists.ADDED, "sql": "b"}]}
    deep = {"code_file": 1, "x": {"code_type": 1, "y": [{"code_label": 1, "z": {"code_version": 1, "keep": 1}}]}}
    assert rawlists.pruned(deep) == {"x": {"y": [{"z": {"keep": 1}}]}}


def test_files_with_names(spark, tmp_path):
    docs = spark.createDataFrame([("a.json", "[1,\n2]"), ("sub/b.json", '{"x": "é"}'), ("a.json", "[9]")], "name string, content string")
    root = records.write_documents(docs, str(tmp_path / "d"))
    assert (tmp_path / "d" / "a.json").read_text().strip() == "[1,\n2]" and json.loads((tmp_path / "d" / "sub" / "b.json").read_text()) == {"x": "é"}
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if not p.name.startswith(".")) == ["a.json", "sub"] and root.endswith("/d")
    records.write_summary(spark.createDataFrame([(1, "x")], "n int, s string").coalesce(1), str(tmp_path / "csv"))
    part = next((tmp_path / "csv").glob("part-*")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfn,s\n1,x")
    info = records.write_sft(spark.createDataFrame([("i", "", "o")], "instruction string, input string, output string"), str(tmp_path / "sft"), "one")
    assert info["one"]["file_name"] == "one" and spark.read.json(str(tmp_path / "sft" / "one")).first().instruction == "i"


def test_metadata_text(spark):
    m = "array<struct<code_key:string,code_value:string,code_file:string>>"
    df = spark.createDataFrame([([("k", "v", "f"), ("", "x", "y"), ("l", "w", None)],), (None,), ([],)], f"m {m}")
    assert [r.t for r in df.select(convert.metadata_text(F.col("m")).alias("t")).collect()] == ["**k**: v (文件: f)\n**l**: w", "", ""]
