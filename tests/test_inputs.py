"""Inputs and sinks on real files, settings, the command line, and functions for SQL users."""

import json
import os

import pytest

from loomspark.__main__ import main
from loomspark.functions.register import register
from loomspark.operators import joining
from loomspark.plans.config import Settings
from loomspark.sources import inputs, records


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_audit_export(spark, tmp_path):
    at = put(tmp_path / "a.csv", 'Id,Sql,Other\n1,"SELECT ""a"",\nb FROM t",x\n2,,y\n')
    df = inputs.read_audit(spark, at)
    assert [r.sql_text for r in df.collect()] == ['SELECT "a",\nb FROM t', None]
    assert df.columns == ["sql_text"]


def test_json_by_suffix(spark, tmp_path):
    lines = put(tmp_path / "a.jsonl", '{"a": 1}\nnot json\n{"a": 2}\n')
    whole = put(tmp_path / "b.json", '[{"a": 1}, {"a": 2}]')
    alone = put(tmp_path / "c.json", '{"a": 3}')
    read = lambda p: sorted(r.a for r in inputs.read_by_suffix(spark, p).selectExpr("variant_get(row, '$.a', 'int') AS a").collect())
    assert (read(lines), read(whole), read(alone)) == ([1, 2], [1, 2], [3])
    both = inputs.merged({"x": records.read_files(spark, whole), "y": records.read_files(spark, alone)})
    assert sorted((r.origin, r.pos) for r in both.collect()) == [("x", 0), ("x", 1), ("y", 0)]


def test_named_files(spark, tmp_path):
    put(tmp_path / "a.json", "[]")
    files, missing = records.read_named(spark, str(tmp_path), ["a.json", "b.json"])
    assert files.count() == 1 and missing == ["b.json"]
    assert records.read_named(spark, str(tmp_path), ["z.json"])[0].count() == 0


def test_catalog_layouts(spark, tmp_path):
    layouts = {
        "alone": spark.createDataFrame([("f",)], "fp string"),
        "with": spark.createDataFrame([("f", "s")], "fp string, sql_text string"),
        "listed": spark.createDataFrame([("f", ["s", "t"], True), ("g", [], None)], "fp string, sql_examples array<string>, extra_add boolean"),
    }
    got = {}
    for name, df in layouts.items():
        df.write.parquet(str(tmp_path / name))
        got[name] = sorted(map(tuple, inputs.read_catalog(spark, str(tmp_path / name)).collect()), key=repr)
    assert got == {"alone": [("f", None, False)], "with": [("f", "s", False)], "listed": [("f", "s", True), ("f", "t", True), ("g", None, False)]}


def test_sinks(spark, tmp_path):
    records.write_split(spark.createDataFrame([(1, "train"), (2, "val")], "a int, split string"), str(tmp_path / "s"))
    assert {d for d in os.listdir(tmp_path / "s") if d.startswith("split=")} == {"split=train", "split=val"}
    records.write_dataset_info(spark, str(tmp_path), "one", {"n": 1})
    assert records.write_dataset_info(spark, str(tmp_path), "two", {"n": 2}) == {"one": {"n": 1}, "two": {"n": 2}}
    rows = records.rows_of(spark.createDataFrame([("f", '[{"a": 1, "x": 2}, {"x": 3}]')], "source string, content string"))
    assert {r.field: r.n for r in records.removed_fields(rows, ("a",)).collect()} == {"x": 2}


def test_settings():
    assert Settings.of(None) == Settings() and Settings.of(Settings().as_json()) == Settings()
    assert Settings.of('{"rewards": {"validity": 0.5}}').rewards.validity == 0.5
    with pytest.raises(ValueError, match="unknown"):
        Settings.of('{"x": 1}')


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_command_line(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "clean_records" in capsys.readouterr().out
    assert main(["run", "dataset_card", "/root/testdata/sf0.001", str(tmp_path / "o"), "--format", "json"], spark) == 0
    assert json.loads(spark.read.text(str(tmp_path / "o")).first()[0])["total"] == 1500
    assert main(["run", "none", "x", "y"], spark) == 2
    put(tmp_path / "in" / "a.json", '[{"a": 1}]')
    assert main(["merge", str(tmp_path / "m"), str(tmp_path / "in")], spark) == 0 and spark.read.parquet(str(tmp_path / "m")).count() == 1


def test_functions_for_sql(spark):
    assert "sql_features" in register(spark)
    row = spark.sql("SELECT sql_features('SELECT a FROM t').features AS f, statements_in('[\"SELECT 1\"]') AS s").first()
    assert row.f == "type_1.tables_t.predicates_" and row.s == ["SELECT 1"]


def test_back_off_and_metadata(spark):
    from pyspark.sql import functions as F

    rows = spark.range(4).select(joining.back_off(F.col("id"), 2.0).alias("linear"), joining.back_off(F.col("id"), 2.0, True, 9.0).alias("doubling")).collect()
    assert [r.linear for r in rows] == [2.0, 4.0, 6.0, 8.0] and [r.doubling for r in rows] == [2.0, 4.0, 8.0, 9.0]
    wrapped = joining.with_metadata(spark.range(3), left="a").first()
    assert (wrapped.n, wrapped.left) == (3, "a") and wrapped.made_at
    picks = {r[0] for r in spark.range(200).select(joining.picked(["x", "y", "z"], F.col("id"))).collect()}
    assert picks == {"x", "y", "z"}
