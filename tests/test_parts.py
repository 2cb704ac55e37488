from pyspark.sql import functions as F

from loomspark.functions import code, prompts
from loomspark.plans.pipeline import Pipeline, curation
from loomspark.sources import adapters


def test_code_parsers():
    go = "package a\nimport (\n \"x\"\n)\ntype U struct {\n A int\n}\nfunc (u U) TableName() string {\n return \"u\"\n}\nfunc F() {\n if x { y() }\n}"
    assert code.clean_code(go) == "func F() {\n if x { y() }\n}"
    assert code.clean_code(None) == ""
    assert code.bracketed_json('text [1, {"a": "]"}] more') == '[1, {"a": "]"}]'
    assert code.bracketed_json("no [ json }") == "" and code.bracketed_json(None) == ""
    nested = [["SELECT 1", "prose"], {"type": "param_dependent", "variants": [{"sql": ["UPDATE a", "x"]}]}, '["DELETE FROM b"]', {"sql": "INSERT INTO c"}, 5]
    assert code.statements_in(nested) == ["SELECT 1", "UPDATE a", "DELETE FROM b", "INSERT INTO c"]
    assert code.statements_in("hello\nselect 1\n") == ["select 1"]


def test_code_columns(spark):
    df = spark.createDataFrame([("package x\nfunc", 'so: ["SELECT 1;"]'), (None, None)], "c string, r string")
    got = df.select(code.cleaned("c").alias("c"), code.balanced("r").alias("b"), code.extracted(F.coalesce(code.balanced("r"), F.lit(""))).alias("e")).collect()
    assert [tuple(g) for g in got] == [("func", '["SELECT 1;"]', ["SELECT 1;"]), ("", "", [])]


def test_prompts(spark):
    df = spark.createDataFrame([([("k", "v", "f"), ("l", "w", "g")], "code", None)], "m array<struct<code_key:string,code_value:string,code_file:string>>, c string, n string")
    r = df.select(
        prompts.fill("generate", code=F.col("c"), caller=F.col("n"), metadata=prompts.metadata_layout(F.col("m"))).alias("p"), prompts.metadata_layout(F.col("m"), "numbered").alias("n"),
        prompts.numbered_variants(F.array(F.lit("a"), F.lit("b"))).alias("v"), prompts.case_key(F.lit("If-Else+x"), F.lit("simple"), F.lit(7)).alias("k"), prompts.without_positions(F.col("m")).alias("w"),
    ).first()
    assert "Method:\ncode\n" in r.p and "{" not in r.p and "k\nv\n\nl\nw" in r.p
    assert r.n == "1. k: v\n\n2. l: w" and r.v == "1. a\n2. b" and r.k == "if_else_x_simple_0007" and r.w[0].asDict() == {"code_key": "k", "code_value": "v"}


def test_packs(spark):
    t = "p struct<scenario:string,code_key:string,code_value:string,sql_pattern_cnt:int,callers:array<struct<code_key:string,code_value:string>>,code_meta_data:array<string>>"
    good = ("s", "k", "v", 1, [("a", "b")], [])
    df = spark.createDataFrame([(good,), (("s", "k", "v", 1, [], []),), (("s", None, "v", 1, [("a", "b")], []),), (("s", "k", "v", 1, [("a", None)], []),)], t)
    assert [r.ok for r in df.select(prompts.valid_pack(F.col("p")).alias("ok")).collect()] == [True, False, False, False]


def test_pipeline_resumes(spark, tmp_path):
    p = Pipeline([("one", lambda d: d.withColumn("a", F.lit(1))), ("two", lambda d: d.withColumn("b", F.col("a") + 1))], str(tmp_path))
    assert p.run(spark, spark.range(3)).where("b = 2").count() == 3
    again = Pipeline(p.steps, p.folder)
    assert again.run(spark, resume="two").count() == 3
    assert [r.step for r in again.step_metrics(spark).collect()] == ["two"]


def test_curation(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    records, items = adapters.records(spark, sf), adapters.items(spark, sf)
    replies = adapters.replies(spark, sf).select(F.col("reply_id").alias("record_id"), "reply")
    run = curation(items, replies, str(tmp_path))
    out = run.run(spark, records)
    assert out.count() == records.count() == out.select("record_id").distinct().count()
    assert {r.list_state for r in out.select("list_state").distinct().collect()} <= {"LIST", "NO_SQL", "LACK_INFO"}
    assert out.where("not is_complete and list_state <> 'LACK_INFO'").count() == 0
