"""All steps of the curation on a few records whose outcome is known, and on the tables."""

import pytest
from pyspark.sql import functions as F

from loomspark.functions import text
from loomspark.plans.workflow import Replies, workflow
from loomspark.sources import adapters

YES = '```json\n{"is_redundant": true, "is_valid_new": false, "is_truly_missing": true}\n```'
WRONG = '```json\n{"final_judgment": {"is_correct": false}}\n```'


def test_known_outcomes(spark, tmp_path):
    code = "func A() { db.Find(u) }"
    flow = "func B() { if x { db.Find(u) } }"
    records = spark.createDataFrame(
        [(1, code, "a", "Preload", "LIST"), (2, code, "b", "", "LIST"), (3, code, "c", "", "LIST"), (4, flow, "a", "", "LIST"), (5, "func C() {}", "a", "", "LIST"), (6, "", "a", "", "NO_SQL")],
        "record_id long, orm_code string, caller string, code_value string, list_state string",
    )
    lists = {1: ["SELECT a FROM t WHERE x = 1", "DELETE FROM u WHERE y = 1"], 2: ["SELECT a FROM t WHERE x = 2"], 3: ["SELECT b FROM other WHERE z = 3"], 4: ["SELECT c FROM f"], 5: ["查询 SELECT", "nothing"]}
    items = spark.createDataFrame([(r, i, 0, "STRING", s) for r, own in lists.items() for i, s in enumerate(own)], "record_id long, item_pos int, variant_pos int, item_kind string, sql_text string")
    one = lambda rows: spark.createDataFrame(rows, "record_id long, reply string")
    # b lacks the deletion, and by its votes truly; c has something new that is no valid addition, and lacks both of a's
    votes = spark.createDataFrame([(code, "b", "missing", YES), (code, "b", "redundant", "否"), (code, "c", "new", YES), (code, "c", "missing", "否")], "orm_code string, caller string, type string, reply string")
    replies = Replies(one([(4, "否，缺少表")]), votes, one([(4, WRONG), (1, WRONG)]), one([(4, '["SELECT c FROM f WHERE x = 1;"]')]), one([(1, '["Preload"]'), (2, "")]))
    run = workflow(items, replies, str(tmp_path / "run"), 0.25)
    out = {r.record_id: r for r in run.run(spark, records).collect()}
    assert out[1].statements == lists[1] and out[1].flow_correct and not out[1].reviewed
    assert out[2].statements == [*lists[2], "DELETE FROM u WHERE y = 1"] and out[2].reviewed
    assert 3 not in out  # its only statement was wrong
    assert out[4].statements == ["SELECT c FROM f WHERE x = 1;"] and not out[4].flow_correct and out[4].list_state == "LACK_INFO"
    assert out[5].statements == [] and out[5].list_state == "NO_SQL"
    assert out[1].keywords == ["Preload"] and [out[k].keyword_status for k in (1, 2, 4)] == ["ok", "failed", "failed"]
    assert sum(r.split == "val" for r in out.values()) == 1
    assert run.names() == ["keyword_tagging", "sql_cleaning", "completeness", "correctness", "review", "control_flow", "keyword_replies", "split"]
    assert run.finish(spark).rsplit("/", 1)[-1].startswith("split-")


def test_on_the_tables(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    pytest.importorskip("os").path.isdir(sf) or pytest.skip("no test tables")
    records, items = adapters.records(spark, sf), adapters.items(spark, sf)
    said = adapters.replies(spark, sf).select(F.col("reply_id").alias("record_id"), "reply")
    votes = records.select("orm_code", "caller").distinct().crossJoin(spark.createDataFrame([("redundant",), ("new",), ("missing",)], "type string")).withColumn("reply", F.when(F.crc32(F.concat("orm_code", "caller")) % 2 == 0, YES).otherwise("否"))
    run = workflow(items, Replies(said, votes, said, said, said), str(tmp_path / "run"))
    out = run.run(spark, records).cache()
    assert 0 < out.count() <= records.count() and out.count() == out.select("record_id").distinct().count()
    assert out.where("reviewed and size(statements) = 0").count() == 0
    assert out.where(F.exists("statements", lambda s: s.endswith(text.REDUNDANT))).count() == 0
    assert out.where("split = 'val'").count() == int(out.count() * 0.1)
