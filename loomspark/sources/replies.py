"""Replies of every kind that the parsers and validators meet, over ``events``; plain SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NL = "' || chr(10) || '"
U = "' || (user_id % 5) || '"


def choice(templates: list[str], key: str = "event_id") -> str:
    """SQL that gives the k-th template where ``key`` modulo their number is k."""
    return f"CASE {key} % {len(templates)} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(templates)) + " END"


ODD = choice([
    f'{{"sql":"SELECT a{U}"}}',
    f"MERGE INTO t{U} USING s{NL}and more",
    f'Take "x_{U}" please',
    f"see [alpha, {U}] ok",
    f"plain prose {U}",
    f"SELECTED {U} rows",
    f'```sql{NL}["A {U}"]{NL}```',
    f'```json{NL}{{bad{NL}```{NL}```json{NL}["B {U}"]{NL}```',
    "",
    '{"a": 1} trailing',
    'Names: [Preload, save, x] and "Locking"',
    "There are no",
    f'"scalar {U}"',
    "[]",
])
REPORT = choice([
    f"NO SQL GENERATE: only a helper {U}{NL}end",
    f"分析 原因：缺 {U}{NL}不能生成SQL",
    f"LACK INFORMATION here{NL}SQL：SELECT * FROM t{U}{NL}",
    "信息缺失 only",
    f"First SELECT a FROM b{U}; then DELETE FROM c; and SELECT d;",
    f"nothing to see {U}",
    f'```json{NL}{{"final_judgment": {{"is_correct": false, "reason": "r{U}"}}, "sql_variants_analysis": {{"expected_count": 3, "actual_count": 2, "issues": ["a", "b"]}}}}{NL}```',
    '{"final_judgment":{}}',
    "garbage",
    f'["U {U};", {{"type":"x"}}]',
])
BROKEN = choice([
    f'["SELECT {U};"]',
    f'"["A {U}", "B"]"',
    f'[\\"A {U}\\"]',
    f"text: SELECT a FROM b{U}; UPDATE c SET d = 1; end",
    f"one {U}; two",
    "{x; y",
]).replace("\\", "' || chr(92) || '")

GO = "func F() error { return nil }"
ORM = f'"method_name": "m", "code": "{GO}", "parameters": [], "return_type": "error"'
VARIANT = '"query": "SELECT a FROM t", "table": "t", "fields": ["a"], "conditions": [], "branch": "x", "description": "d"'
#: Of each validator, a reply that it accepts and one that it rejects.
CASES = [
    ("json", '{"a": 1}', "no braces"),
    ("boolean", "yes", "maybe"),
    ("structured", '{"result": 1}', '{"other": 1}'),
    ("list", "[1, 2]", '{"a": 1}'),
    ("completeness", "否，缺少表", "unclear"),
    ("correctness", "是", "unclear"),
    ("keyword", "No", "Preload"),
    ("redundant", "是，冗余", "冗余"),
    ("control_flow", "合理", "bad"),
    ("regeneration", '["SELECT 1;"]', '["SELECT 1"]'),
    ("sql_generation", '[{"type": "LACK_INFORMATION", "variants": [{"scenario": "s", "sql": "x"}]}]', '[{"type": "other", "variants": []}]'),
    ("fix_review", '{"accepted": true, "replacement": ""}', '{"replacement": ""}'),
    ("precheck", "No", "unclear"),
    ("orm", '[{"scenario": "s", "code_key": "k", "code_value": "v", "sql_pattern_cnt": 1}]', '{"scenario": "s", "code_key": "k"}'),
    ("caller", '{"code_key": "k", "code_value": "v"}', "[]"),
    ("meta", '[{"code_key": "k", "code_value": "v"}]', '{"code_key": "k", "code_value": "v"}'),
    ("reverse_sql", '{"query": "SELECT 1", "table": "t", "fields": [], "conditions": []}', '{"query": "DELETE", "table": "t", "fields": [], "conditions": []}'),
    ("reverse_orm", f'{{{ORM}, "table": "t", "fields": [], "conditions": []}}', f'{{{ORM}, "table": "t", "fields": []}}'),
    ("reverse_caller", f"```json{NL}{{{ORM}}}{NL}```", f'{{{ORM.replace("return nil", "x")}}}'),
    ("reverse_variants", f"[{{{VARIANT}}}]", f"[{{{VARIANT.replace('SELECT', 'DELETE')}}}]"),
    ("synthetic", f'```json{NL}{{"scenario": "s", "code_key": "k", "code_value": "v", "sql_pattern_cnt": null}}{NL}```', '{"scenario": "s"}'),
]
JUDGED = choice([reply for _, *both in CASES for reply in both])


def replies(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """(reply_id, user_id, reply)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.col("event_id").alias("reply_id"), "user_id", F.expr(kind).alias("reply"))


def written(s: str) -> str:
    """A text as an SQL expression that Spark and DuckDB read alike."""
    return "'" + s.replace("'", "''").replace("\\", "' || chr(92) || '").replace("\n", "' || chr(10) || '") + "'"


def nth(texts: list[str], key: str = "event_id") -> str:
    """SQL that gives the k-th text where ``key`` modulo their number is k."""
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {i} THEN {written(t)}" for i, t in enumerate(texts)) + " END"


#: Replies that hold statements in nested values or prose; what they hold, and what they hold by the looser rule.
NESTED = [
    ("please SELECT a from t", ["please SELECT a from t"], ["please SELECT a from t"]),
    ('"SELECT 1"', ["SELECT 1"], ["SELECT 1"]),
    ('["SELECT a;", "hello", 5, null, ["DELETE FROM b;"]]', ["SELECT a;", "DELETE FROM b;"], ["DELETE FROM b;", "SELECT a;", "hello"]),
    ('{"sql": "UPDATE t SET x = 1", "note": "SELECT no"}', ["UPDATE t SET x = 1"], ["SELECT no", "UPDATE t SET x = 1"]),
    ('{"note": "SELECT no", "sql": ["UPDATE t", {"sql": "DELETE u"}]}', ["UPDATE t", "DELETE u"], ["DELETE u", "SELECT no", "UPDATE t"]),
    ('{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "SELECT 1;"}, {"sql": ["SELECT 2;", "SELECT 3;"]}]}', ["SELECT 1;", "SELECT 2;", "SELECT 3;"], ["SELECT 1;", "SELECT 2;", "SELECT 3;", "param_dependent", "s"]),
    ('{"z": "SELECT 1;", "a": {"c": ["INSERT INTO q VALUES (1);"]}}', ["SELECT 1;", "INSERT INTO q VALUES (1);"], ["INSERT INTO q VALUES (1);", "SELECT 1;"]),
    ('["[\\"SELECT 9;\\", {\\"sql\\": \\"DELETE 8;\\"}]", "{\\"sql\\": 1}"]', ["SELECT 9;", "DELETE 8;"], ["DELETE 8;", "SELECT 9;"]),
    ("intro\nSELECT a\n  DELETE b\nend", ["SELECT a", "DELETE b"], ["intro\nSELECT a\n  DELETE b\nend"]),
    ("hello world", [], ["hello world"]),
    ("", [], []),
    (" SELECT led ", ["SELECT led"], ["SELECT led"]),
    ('{"type": "param_dependent"}', [], ["param_dependent"]),
    ('{"type": "LACK_INFORMATION", "variants": [{"scenario": "x", "sql": "SELECT w;"}]}', ["SELECT w;"], ["LACK_INFORMATION", "SELECT w;", "x"]),
    ("12.5", [], []),
    ('so: {"sql": "SELECT 5;"} and ["DROP x"] end', ['so: {"sql": "SELECT 5;"} and ["DROP x"] end'], ["DROP x"]),
    ('{"a": {"b": {"c": {"d": {"e": {"f": "SELECT deep"}}}}}}', ["SELECT deep"], ["SELECT deep"]),
    ('["SELECT 1"] and ["SELECT 2"]', ['["SELECT 1"] and ["SELECT 2"]'], ["SELECT 1"]),
    ("{x: [1}", [], []),
]
J = f"```json{chr(10)}"
K = f"{chr(10)}```"
FULL = '"query": "%s", "table": "t", "fields": %s, "conditions": []'
METHOD = '"method_name": "m", "code": "%s", "parameters": %s, "return_type": "e", "table": "t", "fields": [], "conditions": []'
BRANCH = '"query": "%s", "table": "t", "fields": [], "conditions": [], "branch": "%s", "description": "d"'
#: (validator, reply, code, detail): good replies, fenced, padded, and with null fields, and the first error of bad ones.
VERDICTS = [
    ("json", " [1] ", None, None), ("json", f'x {J}{{"a": 1}}{K}', None, None), ("json", 'so {"a": {}} end', None, None),
    ("json", f"{J}{{a}}{K}", "bad_fence", ""), ("json", "so {a} end", "bad_object", ""), ("json", "[1", "no_json", ""), ("json", "1] x", "no_json", ""), ("json", '"a"], ["b"', "no_json", ""), ("json", '{"a":1}] and more', None, None), ("json", "", "no_json", ""),
    ("boolean", " YES ", None, None), ("boolean", "不是", None, None), ("boolean", "", "empty", ""), ("boolean", "perhaps", "no_verdict", ""),
    ("structured", '{"result": null}', None, None), ("structured", f'{J}{{"result": 1}}{K}', None, None), ("structured", '["result"]', None, None), ("structured", '"the result"', None, None),
    ("structured", '{"other": 1}', "missing_fields", "result"), ("structured", f'{J}["result"]{K}', "no_json", ""), ("structured", 'so {"result": 1}', "unreadable", ""), ("structured", "5", "unreadable", ""), ("structured", f'[1] {J}x{K} {{"a": 1}}', "no_fenced_value", ""),
    ("list", "[]", None, None), ("list", f'{J}[{{"a": 1}}]{K} {{"b": 1}}', "bad_object", ""), ("list", f'{J}[{{"a": 1}}]{K}', None, None), ("list", '{"a": 1}', "not_a_list", ""), ("list", '["a"]] x', "no_json", ""), ("list", 'so {"a": 1}', "unreadable", ""),
    ("completeness", " 是", None, None), ("completeness", "well, no", None, None), ("completeness", "", "empty", ""), ("completeness", "maybe 是", "no_verdict", ""),
    ("correctness", "否 ", None, None), ("correctness", "", "empty", ""), ("correctness", "yes", "no_verdict", ""),
    ("keyword", " No ", None, None), ("keyword", "'No'", None, None), ("keyword", ' ["Preload"] ', None, None), ("keyword", "[]", None, None), ("keyword", "[1, 2]", "not_strings", ""), ("keyword", '["a", 1]', "not_strings", ""), ("keyword", '{"a": "b"}', "not_strings", ""), ("keyword", "no", "unreadable", ""), ("keyword", "", "empty", ""),
    ("redundant", "他说 是，冗余", None, None), ("redundant", "[]", None, None), ("redundant", "冗余", "no_verdict", ""),
    ("control_flow", "不合理", None, None), ("control_flow", "{}", None, None), ("control_flow", "fine", "no_verdict", ""),
    ("regeneration", '["SELECT 1; ", {"type": "param_dependent"}]', None, None), ("regeneration", f'{J}[{{"type": "param_dependent", "variants": [{{"scenario": null, "sql": "x;"}}]}}]{K}', None, None),
    ("regeneration", '["a;", "b"]', "no_semicolon", "1"), ("regeneration", '["a;", {"type": "x"}]', "wrong_type", "1"), ("regeneration", '[{"type": "param_dependent", "variants": 1}]', "variants_not_a_list", "0"), ("regeneration", '[{"type": "param_dependent", "variants": [1]}]', "variant_not_an_object", "0.0"),
    ("regeneration", '[{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "x;"}, {"sql": "x;"}]}]', "variant_fields", "0.1"), ("regeneration", '[{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "x"}]}]', "variant_no_semicolon", "0.0"), ("regeneration", '[{"type": "param_dependent", "variants": [{"scenario": "s", "sql": null}]}]', "unreadable", ""), ("regeneration", "[5]", "wrong_item", "0"), ("regeneration", "{}", "not_a_list", ""),
    ("sql_generation", '[{"type": "NO_SQL_GENERATE", "variants": [{"scenario": "s", "sql": 1}]}]', None, None), ("sql_generation", '[{"type": "LACK_INFORMATION"}, "a;"]', None, None), ("sql_generation", '[{"type": "LACK_INFORMATION", "variants": [{"sql": ""}]}]', "variant_fields", "0.0"), ("sql_generation", '[{"type": null}]', "wrong_type", "0"), ("sql_generation", '["a;", ["b;"]]', "wrong_item", "1"), ("sql_generation", f"{J}x{K}", "no_json", ""),
    ("fix_review", f'{J}{{"accepted": true}}{K}', None, None), ("fix_review", ' {"accepted": false, "replacement": ""} ', None, None), ("fix_review", '{"accepted": "true"}', "accepted_not_boolean", ""), ("fix_review", '{"accepted": true, "replacement": 5}', "replacement_not_a_string", ""), ("fix_review", '{"accepted": true, "replacement": null}', "replacement_not_a_string", ""), ("fix_review", "{}", "missing_fields", "accepted"), ("fix_review", "[true]", "not_an_object", ""),
    ("precheck", " 1 ", None, None), ("precheck", "It Will", None, None), ("precheck", "", "empty", ""), ("precheck", "2", "no_verdict", ""),
    ("orm", '{"scenario": null, "code_key": 1, "code_value": 2, "sql_pattern_cnt": 3}', None, None), ("orm", "[]", "empty_list", ""), ("orm", "[5]", "not_an_object", ""), ("orm", '{"code_value": 1, "scenario": 2}', "missing_fields", "code_key,sql_pattern_cnt"), ("orm", "x", "unreadable", ""),
    ("caller", '[{"code_key": null, "code_value": null}, 5]', None, None), ("caller", "[]", "empty_list", ""), ("caller", '"x"', "not_an_object", ""), ("caller", '{"code_key": 1}', "missing_fields", "code_value"),
    ("meta", "[]", None, None), ("meta", '[{"code_key": 1, "code_value": null}]', None, None), ("meta", "{}", "not_a_list", ""), ("meta", '[{"code_key": 1, "code_value": 2}, 7]', "item_not_an_object", "1"), ("meta", '[{"code_key": 1}]', "item_fields", "0"),
    ("synthetic", f'{J}[{{"scenario": 1, "code_key": 1, "code_value": 1, "sql_pattern_cnt": 1}}]{K}', None, None), ("synthetic", f"{J}x{K}", "no_fenced_value", ""), ("synthetic", "oops", "unreadable", ""), ("synthetic", "[]", "empty_list", ""), ("synthetic", "{}", "missing_fields", "scenario,code_key,code_value,sql_pattern_cnt"),
    ("reverse_sql", f"{J}{{{FULL % (' select 1', '[]')}}}{K}", None, None), ("reverse_sql", f"{{{FULL % ('DELETE', '[]')}}}", "not_a_select", ""), ("reverse_sql", f"{{{FULL % ('SELECT', '5')}}}", "not_a_list_field", "fields"), ("reverse_sql", '{"query": 1, "table": 2}', "missing_fields", "fields,conditions"), ("reverse_sql", '{"query": 1, "table": 2, "fields": [], "conditions": []}', "unreadable", ""), ("reverse_sql", "[]", "not_an_object", ""),
    ("reverse_variants", f"[{{{BRANCH % ('Select', 'b')}}}]", None, None), ("reverse_variants", "[]", None, None), ("reverse_variants", f"[{{{BRANCH % ('Select', 'b')}}}, {{{BRANCH % ('Select', ' ')}}}]", "blank_field", "1:branch"), ("reverse_variants", f"[{{{BRANCH % ('x', 'b')}}}]", "not_a_select", "0"), ("reverse_variants", '[{"query": 1}]', "missing_fields", "0:table,fields,conditions,branch,description"), ("reverse_variants", "[5]", "item_not_an_object", "0"),
    ("reverse_orm", f"{{{METHOD % ('func f() { return }', '[]')}}}", None, None), ("reverse_orm", f"{{{METHOD % (' ', '[]')}}}", "empty_code", ""), ("reverse_orm", f"{{{METHOD % ('func f()', '[]')}}}", "not_go", ""), ("reverse_orm", f"{{{METHOD % ('func', 'null')}}}", "not_a_list_field", "parameters"), ("reverse_orm", '{"code": "x"}', "missing_fields", "method_name,parameters,return_type,table,fields,conditions"),
    ("reverse_caller", f"{J}{{{METHOD % ('FUNC F() RETURN', '[]')}}}{K}", None, None), ("reverse_caller", f"{{{METHOD % ('x', '{}')}}}", "not_a_list_field", "parameters"), ("reverse_caller", f"{{{METHOD % ('return', '[]')}}}", "not_go", ""), ("reverse_caller", '{"method_name": 1, "code": 2, "parameters": [], "return_type": 3}', "unreadable", ""), ("reverse_caller", "[{}]", "not_an_object", ""),
    ("output_format", '["x", {"type": "NO_SQL_GENERATE", "variants": [{"scenario": 1, "sql": ""}]}]', None, None), ("output_format", "SELECT 1", None, None), ("output_format", '{"type": "param_dependent", "variants": []}', None, None), ("output_format", '{"sql": "x"}', "missing_fields", ":type"), ("output_format", '["x", {"type": "y"}]', "wrong_type", "1"), ("output_format", '[{"type": "param_dependent", "variants": [{"scenario": 1, "sql": ""}]}]', "variant_empty_sql", "0.0"),
    ("case", '{"scenario": 1, "base_sql": {"query": 1, "table": 1, "fields": 1, "conditions": 1}, "orm_code": "method_name entity_name table_name fields conditions", "caller_code": null}', None, None), ("case", '{"scenario": 1, "base_sql": 1}', "missing_fields", "orm_code,caller_code"), ("case", '{"scenario": 1, "base_sql": {"query": 1}, "orm_code": 1, "caller_code": 1}', "sql_fields", "table,fields,conditions"), ("case", '{"scenario": 1, "base_sql": ["query", "table", "fields", "conditions"], "orm_code": {"fields": 1}, "caller_code": 1}', "orm_fields", "method_name,entity_name,table_name,conditions"), ("case", "[]", "not_an_object", ""),
    ("sql_data", f"{{{FULL % ('Select 1 From t', '[]')}}}", None, None), ("sql_data", f"{{{FULL % ('SELECT 1', '[]')}}}", "not_sql", ""), ("sql_data", f"{{{FULL % ('SELECT 1 FROM', '[]')}}}", None, None), ("sql_data", f"{{{FULL % ('SELECT 1 FROM', '{}')}}}", "not_a_list_field", "fields"), ("sql_data", '{"query": 1}', "missing_fields", "table,fields,conditions"),
    ("orm_data", f"{{{METHOD % ('x', '[]')}}}", None, None), ("orm_data", f"{{{METHOD % (' ', '[]')}}}", "empty_code", ""), ("orm_data", f"{{{METHOD % ('x', '0')}}}", "not_a_list_field", "parameters"), ("orm_data", "{", "unreadable", ""),
    ("caller_data", '{"method_name": 1, "code": "x", "parameters": [], "return_type": 3}', None, None), ("caller_data", '{"method_name": 1, "code": "", "parameters": [], "return_type": 3}', "empty_code", ""), ("caller_data", '{"code": ""}', "missing_fields", "method_name,parameters,return_type"), ("caller_data", '{"method_name": 1, "code": null, "parameters": [], "return_type": 3}', "unreadable", ""),
    ("output_format", '[{"type": "LACK_INFORMATION", "variants": [{"scenario": 1, "sql": null}]}]', "variant_sql_not_a_string", "0.0"), ("output_format", '[{"type": "LACK_INFORMATION", "variants": [{"sql": 1}]}]', "variant_no_scenario", "0.0"), ("output_format", "[1]", "wrong_item", "0"), ("output_format", " ", "empty", ""),
]
#: Replies with stray brackets, fences and lists; what the parser of replies gives, and what the formatting one gives.
STRAY = [
    ("1] x", ["1] x"], ["1] x;"]),
    ('"a"], ["b"', ["a", "b"], ['"a"], ["b";']),
    ('{"a":1}] and more', ['{"a":1}'], ['{"a":1}] and more;']),
    ('["a"]] x', ["a"], ['["a"]] x;']),
    ('So:\n```json\n["SELECT 1;", "B"]\n```', ["SELECT 1;", "B"], ["SELECT 1;", "B"]),
    (' ["A", {"sql": "x"}] ', ["A", '{"sql":"x"}'], ["A", '{"sql":"x"}']),
    ('["a" b]', ["a"], ['["a" b];']),
    ("a; b ;; c", ["a; b ;; c"], ["a;", "b;", "c;"]),
    ('{"a":1} {"b":2}', ["a", "b"], ['{"a":1} {"b":2};']),
    ("1, 2", ["1, 2"], ["1, 2;"]),
]
#: Statements of every clause: (text, type, tables, feature string or label, names by clause), written out by hand from the rules of fingerprints.
CLAUSED = [
    ("SELECT a, b AS x FROM T1 WHERE c = 5 AND D > 2 GROUP BY a, b ORDER BY b DESC, a LIMIT 3", "SELECT", ["T1"], "type_1.tables_T1.predicates_D_c.has_group_by", {"select": ["a", "b"], "where": ["D", "c"], "group": ["ab"], "order": ["a_b"]}),
    ("SELECT COUNT(*), SUM(v) AS s, COUNT(DISTINCT w) FROM orders o JOIN Lines l ON o.id = l.oid HAVING SUM(v) > 3", "SELECT", ["lines", "orders"], "type_1.tables_lines_orders.predicates_id_oid.has_having", {"select": ["null", "v"], "where": ["id", "oid"]}),
    ("INSERT INTO Acc (Id, name) VALUES (1, 'x')", "INSERT", ["acc"], "type_2.tables_acc.predicates_", {"insert": ["id", "name"]}),
    ("INSERT INTO Acc VALUES (1) ON DUPLICATE KEY UPDATE a = 1", "INSERT", ["Acc"], "type_2.tables_Acc.predicates_", {}),
    ("UPDATE Stock SET Qty = 1, note = 'n' WHERE Item_id IN (1, 2)", "UPDATE", ["stock"], "type_3.tables_stock.where_columns_Item_id", {"update": ["note", "qty"], "where": ["Item_id"]}),
    ("DELETE FROM Sess WHERE token LIKE 'a%' OR old = 1", "DELETE", ["sess"], "type_4.tables_sess.predicates_old_token", {"where": ["old", "token"]}),
    ("SELECT count FROM t WHERE sum > 1", "SELECT", ["t"], "type_1.tables_t.predicates_sum.aggregations_count_1", {"select": ["count"], "where": ["sum"]}),
    ("SELECT count > 1, (SELECT max FROM u) AS m FROM w", "SELECT", ["w"], "type_1.tables_w.predicates_.aggregations_count_1_max_1", {"select": ["count", "null"]}),
    ("SELECT 1 > avg, f(sum, 2), min IN (min, avg), LOWER(count) FROM w", "SELECT", ["w"], "type_1.tables_w.predicates_.aggregations_avg_1_count_1_min_2_sum_1", {"select": ["1", "count", "f", "min"]}),
    ("WITH c AS (SELECT min FROM z WHERE q = 1) SELECT k FROM c", "SELECT", ["c", "z"], "type_1.tables_c_z.predicates_q.aggregations_min_1", {"select": ["k", "min"], "where": ["q"]}),
    ("SELECT a FROM x UNION SELECT b FROM y ORDER BY a", "SELECT", ["x"], "type_1.tables_x.predicates_", {"select": ["a"]}),
    ("SELECT a FROM x UNION ALL SELECT b FROM y WHERE k = 'v' UNION SELECT c FROM z", "SELECT", ["y"], "type_1.tables_y.predicates_k", {"select": ["b"], "where": ["k"]}),
    ("SELECT * FROM (SELECT a FROM b) s WHERE s.x NOT BETWEEN 1 AND 2 ORDER BY s.a", "SELECT", ["null"], "type_1.tables_null.predicates_x", {"select": ["null"], "where": ["x"], "order": ["a"]}),
    ("SELECT a FROM b WHERE x IN (SELECT count FROM z) AND EXISTS (SELECT 1 FROM q)", "SELECT", ["b"], "type_1.tables_b.predicates_x", {"select": ["a"], "where": ["x"]}),
    ("BEGIN ;", "UNKNOWN", [], "transaction_start", {}),
    ("BEGIN", "UNKNOWN", [], "transaction_begin", {}),
    ("START TRANSACTION;", "UNKNOWN", [], "transaction_begin", {}),
    ("USE shop", "UNKNOWN", [], "tables_.predicates_", {}),
    ("(SELECT a FROM b)", "UNKNOWN", [], "invalid_sql", {}),
    ("SELECT FROM WHERE", "UNKNOWN", [], "invalid_sql", {}),
]

#: Replies to the simpler parser of statements, and what it gives; texts of prose to the one that gathers statements, and what it gives.
SIMPLE = [
    ('["SELECT 1", "", {"a": 1}, null, 0]', ["SELECT 1", '{"a":1}']), ('"SELECT 2"', ["SELECT 2"]), ('{"sql": "SELECT 3"}', []), ('see ["A", "B"] and ["C"]', ["A", "B"]), ('say "select x" or "hello" or "DROP y"', ["select x", "DROP y"]),
    ("plain", ["plain"]), ("  ", []), ('[bad] "x"', ['[bad] "x"']), ("5", []), ('""', []),
]
GROUP = '{"type": "param_dependent", "variants": [{"scenario": "s", "sql": "SELECT g; "}]}'
PROSE = [
    (f"first {GROUP} then DELETE h;", [GROUP, "DELETE h;"]), ("Use SELECT a FROM b; or\nupdate c set d = 1; end", ["SELECT a FROM b;", "update c set d = 1;"]), ("one; {x}; two", ["one;", "two;"]), ("", []), ("select without end", ["select without end;"]),
]
#: Judges' replies and the severity in them.
SEVERITIES = [
    ('{"penalty_severity": "high", "severity": 0.5}', 0.0), ('{"penalty_severity": "0.25"}', 0.25), ('{"penalty_severity": [1], "severity": 0.5}', 0.5), ('{"penalty_severity": null, "penalty_evaluation": {"severity": 3}}', 1.0),
    ('{"penalty_evaluation": {"penalty_evaluation": {"severity": 0.75}}}', 0.75), ('{"severity": true}', 1.0), ('x {"severity": -2} y', 0.0), ("none", 0.0), ('```json\n{"severity": 0.125}\n```', 0.125), ('{"severity": {"severity": 1}}', 0.0),
]
#: Judges' replies about one statement of a candidate, and for which types they confirm.
VOTES = [
    (f'{J}{{"is_redundant": true, "is_valid_new": true, "is_truly_missing": true}}{K}', ("redundant", "new", "missing")), (f'{J}{{"is_redundant": false}}{K}', ()), ("是，冗余", ("redundant",)), ("否", ()),
    (f'{J}{{"is_redundant": "true", "is_valid_new": 1}}{K}', ()), (" 是", ("redundant",)), (f"{J}{{broken}}{K}", ()), ("说：合理新增", ("new",)), ("确实缺失", ("missing",)),
]
