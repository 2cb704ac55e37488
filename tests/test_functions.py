import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions import responses, text
from loomspark.functions.fingerprint import features, fingerprint
from loomspark.operators import diff, sampling, scoring
from loomspark.sources import records
from loomspark.streaming import reward_log

GOLDEN = [
    ("SELECT count, t.sum AS s, id FROM t WHERE id IN (SELECT min FROM u)", "type_1.tables_t.predicates_id.aggregations_count_1_sum_1"),
    ("SELECT id FROM User WHERE a = N AND b LIKE 'S'", "type_1.tables_User.predicates_a_b"),
    ("SELECT o.id FROM orders o JOIN Users u ON o.uid = u.id", "type_1.tables_orders_users.predicates_id_uid"),
    ("UPDATE `Stock` SET qty = N WHERE item_id = N", "type_3.tables_stock.where_columns_item_id"),
    ("INSERT INTO T VALUES (1)", "type_2.tables_T.predicates_"),
    ("INSERT INTO T (a) VALUES (1)", "type_2.tables_t.predicates_"),
    ("DELETE FROM s WHERE a IN (N) AND NOT (b = N)", "type_4.tables_s.predicates_a_b"),
    ("SELECT * FROM a UNION SELECT * FROM b WHERE x = N", "type_1.tables_a.predicates_"),
    ("WITH q AS (SELECT a FROM m WHERE n = N) SELECT * FROM q", "type_1.tables_m_q.predicates_n"),
    ("SELECT * FROM (SELECT a FROM b WHERE c = N) t WHERE z = N", "type_1.tables_null.predicates_z"),
    ("SELECT x FROM t WHERE a IS NULL AND DATE(b) = N AND d BETWEEN 1 AND 2 LIMIT N, 20", "type_1.tables_t.predicates_d"),
    ("SELECT COUNT(*) FROM c GROUP BY d HAVING COUNT(*) > 2", "type_1.tables_c.predicates_.has_group_by.has_having"),
    ("USE db", "tables_.predicates_"),
    ("SELECT FROM WHERE", None),
    ("(SELECT 1)", None),
    ("", "empty_sql"),
]


@pytest.mark.parametrize("sql,want", GOLDEN)
def test_features(sql, want):
    assert features(sql)[0] == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="SELECT FROM WHERE(),='`\"abc 01;*.-", max_size=60))
def test_features_never_fail(sql):
    features(sql)


def test_fingerprint_labels(spark):
    rows = [("SELECT NOW()", "system_function_now"), ("begin", "transaction_begin"), ("ROLLBACK;", "transaction_end"), ("SET a = 1", "session_setting"), ("SHOW TABLES", "show_command"), ("DROP TABLE x", "ddl_command"), ("hello", "not_sql"), ("SELECT FROM", "invalid_sql"), ("SELECT a FROM b -- c", hashlib.md5(b"type_1.tables_b.predicates_").hexdigest()), (None, None)]
    got = fingerprint(spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "i int, sql_text string")).select("i", "fp").collect()
    assert dict(got) == {i: fp for i, (_, fp) in enumerate(rows)}


def test_normalize(spark):
    cases = [("SELECT  1 -- x\nFROM a", "SELECT 1 FROM a"), ("a /* b\nc */ = 12.5", "a = N.5"), ("LIMIT 10, 20", "LIMIT N, 20"), ("x >= 5 and y > 5", "x >= N and y > 5"), ("FROM `t12` t3 ", "FROM `t_alias` t3"), ("in (1,2 , 3)", "IN (N)"), ("'a' \"b\"", "'S' \"S\"")]
    df = spark.createDataFrame(cases, "s string, want string").select(text.normalize_sql(F.col("s")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
    again = df.select(text.normalize_sql(F.col("got")).alias("twice"), "got").collect()
    assert all(r.twice == r.got for r in again)


def test_validators(spark):
    cases = {
        "fix_review": [('{"accepted": true}', True), ('{"accepted": 1', False), (None, False)],
        "sql_generation": [('["a;", {"type": "NO_SQL_GENERATE", "variants": [{"scenario": "s", "sql": "x"}]}]', True), ('["a"]', False), ('[{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "x;"}]}]', True), ('[{"type": "other", "variants": []}]', False)],
        "regeneration": [('[{"type": "NO_SQL_GENERATE", "variants": [{"scenario": "s", "sql": "x"}]}]', False), ('["a;"]', True), ("[", False)],
        "meta": [('[{"code_key": "k", "code_value": "v"}]', True), ('[{"code_key": "k"}]', False)],
        "reverse_sql": [('{"query": "select 1", "table": "t", "fields": [], "conditions": []}', True), ('{"query": "x", "table": "t", "fields": [], "conditions": []}', False)],
        "reverse_caller": [('{"method_name": "m", "code": "Func x() { RETURN }", "parameters": [], "return_type": null}', True), ('{"code": "func x() { return }", "parameters": []}', False)],
        "structured": [('{"result": 1}', True), ('{"r": 1}', False)],
        "keyword": [("No", True), ('["a"]', True), ("none", False)],
        "control_flow": [("不合理", True), ("x", False)],
    }
    for name, rows in cases.items():
        got = spark.createDataFrame([(r,) for r, _ in rows], "reply string").select(responses.validator(name)(F.col("reply")).alias("ok")).collect()
        assert [r.ok for r in got] == [ok for _, ok in rows], name


def test_record_files(spark, tmp_path):
    meta = {"code_file": "f", "code_start_line": 1, "code_end_line": 2, "code_key": "k", "code_value": "v"}
    rows = [
        {"function_name": "a", "sql_statement_list": []},
        {"function_name": "b", "sql_statement_list": "<NO SQL GENERATE>"},
        {"function_name": "c", "sql_statement_list": ["<NO SQL GENERATE>"]},
        {"function_name": "d", "sql_statement_list": "SELECT 1"},
        {"function_name": "e", "sql_statement_list": {"type": "x"}},
        {"function_name": "f", "sql_statement_list": ["A", ["B", "C"], {"type": "param_dependent", "variants": [{"scenario": "s", "sql": ["D", "E"]}]}]},
        {"function_name": "g", "code_meta_data": [{"code_file": "f"}]},
        {"function_name": "h", "code_meta_data": [meta | {"more": 1}]},
        {"function_name": "i", "code_meta_data": [meta | {"code_version": "1"}]},
    ]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text(json.dumps({"data": rows[:1]}))
    aligned = records.align(records.rows_of(records.read_files(spark, str(tmp_path)))).cache()
    states = {r.function_name: r.list_state for r in aligned.where("record_id like '%a.json%'").collect()}
    assert states == {"a": "EMPTY", "b": "NO_SQL", "c": "NO_SQL", "d": "STRING", "e": "OTHER", "f": "LIST", "g": "OTHER", "h": "OTHER", "i": "OTHER"}
    assert {r.function_name for r in aligned.where("rejected is not null").collect()} == {"g", "h"}
    assert aligned.count() == len(rows) + 1
    items = records.items_of(aligned).orderBy("item_pos", "sub_pos", "variant_pos", "sql_pos").collect()
    assert [r.sql_text for r in items if r.record_id.endswith("#5")] == ["A", "B", "C", "D", "E"]
    assert [r.sql_text for r in items if r.record_id.endswith("#3")] == ["SELECT 1"]


def test_diff_laws(spark):
    rows = [("m", "a", f"s{i}", f"f{i}", i) for i in range(4)] + [("m", "b", "s1", "f1", 9), ("m", "b", "s9", "f9", 10), (" ", "c", "s", "f", 11)]
    sets = diff.caller_sets(spark.createDataFrame(rows, "orm_code string, caller string, sql_text string, fp string, seen int"))
    d = diff.caller_diff(sets).collect()
    assert len(d) == 1 and d[0].reference == "a" and d[0].common == ["f1"] and d[0].missing == ["f0", "f2", "f3"] and d[0].extra == ["f9"]
    assert d[0].n_common + d[0].n_missing == 4 and d[0].n_common + d[0].n_extra == 2


def test_samples(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 7).withColumn("top", F.col("id") < 30)
    assert sampling.sample(df, 77, "id").count() == 77
    assert sampling.sample(df, 77, "id").exceptAll(sampling.sample(df, 77, "id")).count() == 0
    s = sampling.stratified(df, "g", 70, "id")
    assert s.count() == 70 and min(r["count"] for r in s.groupBy("g").count().collect()) >= 9
    g = sampling.guaranteed(df, "top", 100, "id")
    assert g.count() == 100 and g.where("top").count() == 30
    assert sampling.guaranteed(df, "top", 10, "id").where("top").count() == 10
    assert {r.split: r["count"] for r in sampling.train_val(df, 0.1, "id").groupBy("split").count().collect()} == {"val": 100, "train": 900}


def test_reward_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"score": 0.9, "function_name": "f", "timestamp": 1}\nbroken\n{"score": 0.1}\n')
    q = reward_log.append(reward_log.read(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    got = {(r.score, r.band) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(0.9, "0.8-1.0"), (0.1, "0.0-0.4")}
    assert reward_log.read(spark, str(tmp_path / "in"), streaming=False).count() == 2


def test_rewards_by_hand(spark):
    """Figures worked out by hand from the reward rules."""
    row = spark.range(1).select(
        scoring.reward_five(*[F.lit(1.0)] * 4, F.lit(0.0)).alias("all_ones"),
        scoring.reward_five(F.lit(1.0), F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0), F.lit(0.5)).alias("no_keywords"),
        scoring.composite(F.lit(1.0), F.lit(0.5), F.lit(1.0), F.lit(0.33), F.lit(1), F.lit(0)).alias("composite"),
        scoring.consistency(F.array(F.lit("Users")), F.array(F.lit("`users`")), F.array(F.lit("ID")), F.array(F.lit("id"), F.lit("x"))).alias("consistency"),
        scoring.reward_v1(F.lit(1.0), F.lit(0.5), F.lit(None).cast("double"), F.lit(0.5)).alias("v1"),
        scoring.clamp(F.lit(None).cast("double")).alias("nothing"),
    ).first()
    assert (row.all_ones, row.no_keywords, row.composite, row.consistency, row.nothing) == (0.8, 0.9, 0.7, 0.8, None)
    assert round(row.v1, 6) == 0.65


def test_simple_statements(spark):
    cases = [("SHOW TABLES", True), ('SELECT "a', True), ("SELECT 'a", False), ("GRANT x", False), ("SELECT (1", False)]
    got = spark.createDataFrame([(c,) for c, _ in cases], "s string").select(text.is_simple_sql(F.col("s")).alias("ok")).collect()
    assert [r.ok for r in got] == [ok for _, ok in cases]


def test_json_is_read_whole(spark):
    cases = [('{"a": 1} x', None), ("3 rows", None), ('["a", {"b": 1}]', ["a", '{"b":1}']), ('"x"', ["x"]), ("[]", [])]
    got = spark.createDataFrame([(c,) for c, _ in cases], "s string").select(responses.json_items(F.col("s")).alias("items")).collect()
    assert [r["items"] for r in got] == [want for _, want in cases]
