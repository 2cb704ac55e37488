"""DuckDB SQL for ``plans.more_queries``: what each kind of reply gives is written out by hand from the rules."""

from __future__ import annotations

from ..functions import scenarios
from ..sources import adapters as src
from ..sources import replies as said
from . import more_queries as more
from .oracle import AUDIT_FP, CLASS, EXCLUDED, HALF_EVEN
from .oracle import SQL as BASE

EVENTS = "p AS (SELECT event_id AS reply_id, event_id, user_id FROM events)"


def by_kind(outcomes: dict[int, str], n: int, default: str = "''") -> str:
    return f"CASE reply_id % {n} " + " ".join(f"WHEN {k} THEN {v}" for k, v in outcomes.items()) + f" ELSE {default} END"


def outcome(texts: list[list[str]]) -> str:
    """The joined statements of the k-th kind of reply."""
    return f"CASE reply_id % {len(texts)} " + " ".join(f"WHEN {k} THEN {said.written(' ## '.join(t))}" for k, t in enumerate(texts)) + " END"


def each_outcome(texts: list[list[str]]) -> str:
    """(k, x): a row for each statement of the k-th kind."""
    rows = ", ".join(f"({k}, {said.written(x)})" for k, own in enumerate(texts) for x in own)
    return f"o(k, x) AS (VALUES {rows})"


def nullable(s: str | None) -> str:
    return "NULL" if s is None else said.written(s)


VERDICTS = "o(k, validator, code, detail) AS (VALUES " + ", ".join(f"({k}, '{n}', {nullable(c)}, {nullable(d)})" for k, (n, _, c, d) in enumerate(said.VERDICTS)) + ")"
LABELS = ("transaction_start", "transaction_begin", "not_sql", "invalid_sql")
CLAUSED = "o(k, stmt_type, fp) AS (VALUES " + ", ".join(f"({k}, '{t}', {said.written(f) if f in LABELS else f'md5({said.written(f)})'})" for k, (_, t, _, f, _) in enumerate(said.CLAUSED)) + ")"
NAMED = "o(k, stmt_type, clause, tab, name) AS (VALUES " + ", ".join(
    f"({k}, '{t}', {nullable(c)}, {nullable(tab)}, {nullable(n)})" for k, (_, t, tabs, _, named) in enumerate(said.CLAUSED) for tab in tabs or [None] for c, n in [(c, n) for c, own in named.items() for n in own] or [(None, None)]
) + ")"
U = "(user_id % 5)"
LINES = {1: f"'MERGE INTO t' || {U} || ' USING s'", 5: f"'SELECTED ' || {U} || ' rows'"}
PARSED = LINES | {
    0: f"""'{{"sql":"SELECT a' || {U} || '"}}'""", 2: f"'x_' || {U}", 3: f"'alpha, ' || {U}", 4: f"'plain prose ' || {U}", 6: f"'A ' || {U}", 7: f"'B ' || {U}",
    9: """'{"a":1}'""", 10: "'Locking'", 11: "'There are no'", 12: f"'scalar ' || {U}",
}
REPAIRED = {0: f"'SELECT ' || {U} || ';'", 1: f"'A ' || {U} || ' ## B'", 2: f"'A ' || {U}", 3: f"'SELECT a FROM b' || {U} || '; ## UPDATE c SET d = 1;'", 4: f"'one ' || {U} || '; ## two;'", 5: "'y;'"}
TASK = """t AS (SELECT o_custkey % 200 AS function, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'c' || (o_orderkey % 9) END AS caller, o_orderkey AS pos,
  CASE (o_custkey % 200) % 4 WHEN 0 THEN 'mutual_exclusive_conditions' WHEN 1 THEN 'table_name_from_caller' WHEN 2 THEN 'condition_field_mapping' ELSE 'with_first' END AS scenario FROM orders)"""
RUNS = "r AS (SELECT " + ", ".join(f"({e}) AS {n}" for n, e in more.RUN.items()) + " FROM events)"
KEYWORD = "CASE WHEN doc_id % 2 = 0 AND doc_id % 3 <> 0 THEN CASE doc_id % 5 WHEN 0 THEN 0.7::DOUBLE WHEN 1 THEN 1.0 WHEN 4 THEN 0.25 ELSE 0 END END"
SEVERITY = "CASE doc_id % 6 WHEN 0 THEN 0.4::DOUBLE WHEN 1 THEN 1.0 WHEN 2 THEN 0.3 WHEN 5 THEN 0.5 ELSE 0 END"
LABELLED = "d AS (SELECT DISTINCT doc_id FROM labels)"
MANY = f"(VALUES {', '.join(f"('{s}', {a}, {b})" for s, (a, b) in scenarios.SCENARIO_VARIANTS.items())})"
LEVELS = f"(VALUES {', '.join(f"('{s}', {a}, {b})" for s, (a, b) in scenarios.LEVEL_VARIANTS.items())})"
JACCARD_LOWER = "CASE WHEN len(list_distinct({a} || {b})) = 0 THEN 0 ELSE len(list_intersect({a}, {b})) / len(list_distinct({a} || {b}))::DOUBLE END"
LOW = "list_distinct(list_transform({0}, lambda x: lower(x)))"

SQL = {
    "parse_odd_responses": f"WITH {EVENTS} SELECT reply_id, {by_kind(PARSED, 14)} AS statements FROM p",
    "odd_keyword_responses": f"WITH {EVENTS} SELECT reply_id, {by_kind({10: "'Preload|save|Locking'"}, 14)} AS keywords FROM p",
    "format_responses": f"WITH {EVENTS}, q AS (SELECT reply_id, ({said.ODD}) AS reply FROM p) SELECT reply_id, CASE WHEN reply_id % 14 IN (8, 13) THEN '' ELSE reply || ';' END AS statements FROM q",
    "repair_responses": f"WITH {EVENTS} SELECT reply_id, {by_kind(REPAIRED, 6)} AS statements FROM p",
    "analysis_reports": f"""WITH {EVENTS} SELECT reply_id, CASE reply_id % 10 WHEN 2 THEN 'LACK_INFORMATION' WHEN 3 THEN 'LACK_INFORMATION' WHEN 4 THEN 'SQL' ELSE 'NO_SQL_GENERATE' END AS kind,
      CASE reply_id % 10 WHEN 0 THEN 'only a helper ' || {U} WHEN 1 THEN '缺 ' || {U} WHEN 2 THEN '信息缺失' WHEN 3 THEN '信息缺失' WHEN 4 THEN '' ELSE '无法解析LLM响应' END AS scenario,
      CASE reply_id % 10 WHEN 2 THEN 'SELECT * FROM t' || {U} WHEN 4 THEN 'SELECT a FROM b' || {U} || '; ## SELECT d; ## DELETE FROM c;' ELSE '' END AS statements FROM p""",
    "control_flow_verdicts": f"""WITH {EVENTS} SELECT reply_id, reply_id % 10 <> 6 AS is_correct, CASE WHEN reply_id % 10 = 6 THEN 'r' || {U} ELSE '' END AS reason,
      CASE WHEN reply_id % 10 = 6 THEN 3 END AS expected_count, CASE WHEN reply_id % 10 = 6 THEN 2 END AS actual_count, CASE WHEN reply_id % 10 = 6 THEN 2 ELSE 0 END AS n_issues, reply_id % 10 NOT IN (6, 7) AS unreadable FROM p""",
    "regenerated_statements": f"""WITH {EVENTS} SELECT reply_id, CASE reply_id % 10 WHEN 7 THEN '{{"final_judgment":{{}}}}' WHEN 9 THEN 'U ' || {U} || '; ## {{"type":"x"}}' END AS statements FROM p""",
    "validator_cases": "SELECT CASE (event_id % {0}) // 2 {1} END AS validator, event_id % {0} % 2 = 0 AS ok, count(*) AS n FROM events GROUP BY ALL".format(2 * len(said.CASES), " ".join(f"WHEN {i} THEN '{n}'" for i, (n, *_) in enumerate(said.CASES))),
    "judge_scores": f"WITH {LABELLED} SELECT doc_id, {KEYWORD} AS keyword, {SEVERITY} AS severity FROM d",
    "reward_v1": f"""WITH {LABELLED}, s AS (SELECT doc_id, {KEYWORD} AS k, {SEVERITY} AS v FROM d)
      SELECT doc_id, round(greatest({HALF_EVEN("least(0.6::DOUBLE * (doc_id % 8) / 8 + 0.4::DOUBLE * (doc_id % 5) / 5 + 0.1::DOUBLE * coalesce(k, 0), 1)", 2)} - 0.3::DOUBLE * v, 0), 6) AS reward FROM s""",
    "sample_consistency": f"""WITH {AUDIT_FP}, x AS (SELECT user_id, {LOW.format('tables')} AS t, {LOW.format('columns')} AS c, ['user' || (user_id % 5) || '_items'] AS lt, ['id', 'name'] AS lc FROM f WHERE len(tables) > 0),
      y AS (SELECT user_id, CASE WHEN user_id % 11 <> 0 AND user_id % 7 <> 0 THEN {HALF_EVEN(f"0.6::DOUBLE * ({JACCARD_LOWER.format(a='t', b='lt')}) + 0.4::DOUBLE * ({JACCARD_LOWER.format(a='c', b='lc')})", 2)} END AS s FROM x)
      SELECT user_id, count(s) AS n, coalesce({HALF_EVEN('avg(s)', 2)}, 0) AS score FROM y GROUP BY user_id""",
    "parameter_shares": "SELECT l_orderkey AS sample, count(*) FILTER (l_partkey % 6 <> 0) AS n, count(*) FILTER (l_partkey % 6 <> 0 AND l_partkey % 9 < 5) AS n_known, round(CASE WHEN count(*) FILTER (l_partkey % 6 <> 0) = 0 THEN 1 ELSE count(*) FILTER (l_partkey % 6 <> 0 AND l_partkey % 9 < 5) / count(*) FILTER (l_partkey % 6 <> 0)::DOUBLE END, 6) AS score FROM lineitem GROUP BY 1",
    "match_samples": """WITH b AS (SELECT o_orderkey, 'f' || (o_custkey % 50) AS s, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 40 END AS c, 'm' || (o_orderkey % 6) AS f, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey % 300 END AS id FROM orders),
      g AS (SELECT 'f' || (o_custkey % 70) AS s, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 40 END AS c, 'm' || (o_orderkey % 6) AS f, o_custkey % 500 AS id, o_orderkey AS pos FROM orders WHERE o_custkey % 2 = 0),
      m AS (SELECT o_orderkey, (SELECT min(pos) FROM g WHERE g.s = b.s AND g.f = b.f AND g.c IS NOT DISTINCT FROM b.c) AS one, (SELECT min(pos) FROM g WHERE g.id = b.id AND b.id <> 0) AS two FROM b)
      SELECT o_orderkey, coalesce(one, two) AS match, CASE WHEN one IS NOT NULL THEN 'triple' WHEN two IS NOT NULL THEN 'id' END AS matched_by FROM m""",
    "regroup_tasks": f"""WITH {TASK}, k AS (SELECT * FROM t WHERE caller <> '' OR (scenario NOT IN ('mutual_exclusive_conditions', 'table_name_from_caller') AND pos = (SELECT max(pos) FROM t AS u WHERE u.function = t.function AND u.caller = '')))
      SELECT function, caller, pos, row_number() OVER (PARTITION BY function ORDER BY caller <> '', pos)::INTEGER AS place FROM k""",
    "route_scenarios": f"WITH {TASK} SELECT CASE scenario WHEN 'with_first' THEN 'standard' ELSE scenario END AS route, scenario <> 'with_first' AS base, count(*) AS n FROM t GROUP BY ALL",
    "example_packs": f"WITH {TASK} SELECT scenario, min(pos) AS example FROM t GROUP BY 1",
    "staged_analysis": """WITH q AS (SELECT o_orderkey AS record_id, o_orderkey % 11 <> 0 AS said, CASE WHEN o_orderkey % 3 = 0 THEN 'F' || (o_custkey % 3) || ';' WHEN o_orderkey % 7 = 0 THEN 'UPDATE v; ## x;' WHEN o_orderkey % 4 > 0 THEN 'SELECT a' || (o_custkey % 3) || '; ## DELETE b;' END AS best FROM orders)
      SELECT record_id, CASE WHEN said AND record_id % 5 = 0 THEN 'no_sql' WHEN NOT said OR best IS NULL THEN 'failed' ELSE 'analysed' END AS outcome, CASE WHEN said AND record_id % 5 <> 0 THEN best END AS statements FROM q""",
    "case_shapes": """SELECT 'k' || o_orderkey AS case_key, ['full', 'if_else', 'switch', 'dynamic'][o_orderkey % 4 + 1] AS shape,
      '{"scenario":"s' || (o_orderkey % 4) || '",' || CASE WHEN o_orderkey % 4 = 0 THEN '"complexity":"simple",' ELSE '' END || '"base_sql":"q","orm_code":"m","caller_code":"c","' ||
      ['control_flow_sqls', 'if_else_sqls', 'switch_sqls', 'dynamic_sqls'][o_orderkey % 4 + 1] || '":["v"],"metadata":{"version":"1.0"}}' AS "case" FROM orders""",
    "scenario_success": f"""WITH s AS (SELECT ({more.CASE_SCENARIO}) AS scenario, o_orderkey % 8 > 2 AND o_custkey % 5 > 0 AS valid FROM orders), a AS (SELECT * FROM {MANY} AS m(scenario, least, most))
      SELECT a.scenario, count(s.scenario) AS total, count(*) FILTER (s.valid) AS valid, round(100 * count(*) FILTER (s.valid) / greatest(count(s.scenario), 1)::DOUBLE, 1) AS rate, count(s.scenario) > 0 AND 2 * count(*) FILTER (s.valid) < count(s.scenario) AS low
      FROM a LEFT JOIN s ON s.scenario = a.scenario GROUP BY 1""",
    "variant_bounds": f"""SELECT scenario, level, CASE WHEN greatest(a, c) > least(b, d) THEN a ELSE greatest(a, c) END AS least, CASE WHEN greatest(a, c) > least(b, d) THEN b ELSE least(b, d) END AS most
      FROM {MANY} AS m(scenario, a, b) CROSS JOIN {LEVELS} AS l(level, c, d)""",
    "report_precision": f"""WITH {AUDIT_FP}, m AS (SELECT fp, fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 0) AS hit, fp IN ('transaction_end', 'show_command', 'session_setting', 'ddl_command', 'invalid_sql', 'not_sql') AS out FROM f WHERE stmt_id % 2 = 1),
      n AS (SELECT count(*) FILTER (NOT out AND hit) AS matched, count(*) FILTER (NOT out AND NOT hit) AS unmatched, count(*) FILTER (out) AS excluded FROM m)
      SELECT *, matched + unmatched AS valid, {HALF_EVEN('matched / (matched + unmatched)::DOUBLE', 4)} AS precision FROM n""",
    "combined_report": f"""WITH i AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM lineitem WHERE {src.LISTED} GROUP BY 1), r AS (SELECT coalesce(n, 0) AS n, ({src.ORM_CODE}) AS code FROM orders LEFT JOIN i ON o_orderkey = k)
      SELECT 'basic' AS section, 'total' AS metric, count(*)::DOUBLE AS value FROM r UNION ALL SELECT 'basic', 'with_sql', count(*) FILTER (n > 0) FROM r UNION ALL SELECT 'basic', 'mean_items', round(avg(n), 6) FROM r
      UNION ALL SELECT 'code', 'mean_length', round(avg(length(code)), 6) FROM r UNION ALL SELECT 'code', 'with_caller', count(*) FROM r UNION ALL SELECT 'quality', 'orm_code', round(100 * avg((code <> '')::INTEGER), 6) FROM r""",
    "rl_ground_truth": f"""WITH i AS (SELECT l_orderkey AS k, '[' || string_agg('"' || ({src.STATEMENT}) || '"', ',' ORDER BY l_linenumber, ({src.STATEMENT})) || ']' AS g FROM lineitem WHERE {src.LISTED} AND ({src.KIND}) = 'STRING' AND ({src.STATEMENT}) <> '' GROUP BY 1)
      SELECT o_orderkey AS record_id, coalesce(g, '[]') AS ground_truth FROM orders LEFT JOIN i ON o_orderkey = k""",
    "dataset_card": "SELECT 'orm_to_sql' AS dataset_name, count(*) FILTER (o_orderkey % 10 <> 0) AS train, count(*) FILTER (o_orderkey % 10 = 0) AS val, count(*) AS total, 'rule' AS reward_model_style FROM orders",
    "validation_export": f"SELECT o_orderkey AS record_id, CASE WHEN length({src.ORM_CODE}) > 50 THEN substr({src.ORM_CODE}, 1, 50) || '...' ELSE {src.ORM_CODE} END AS orm_code, 'caller' || (o_orderkey % 4) AS caller, ({src.STATE}) AS list_state FROM orders WHERE ({src.ORM_CODE}) <> ''",
    "empty_validation": "SELECT 0 AS candidates, 0 AS confirmed, 0::DOUBLE AS rate",
    "generation_validity": "SELECT count(*) FILTER (event_id % 9 = 0) AS valid, count(*) FILTER (event_id % 9 <> 0) AS invalid, round(count(*) FILTER (event_id % 9 = 0) / count(*)::DOUBLE, 6) AS rate FROM events",
    "generation_files": "SELECT path, path LIKE '%/core/%' AS privileged FROM (SELECT event_id, user_id, (" + more.PATH + ") AS path FROM events) WHERE event_id % 5 <> 0 AND user_id % 3 = 0 AND event_id % 4 <> 0",
    "latest_run": f"WITH {RUNS} SELECT run FROM r WHERE kind = 'workflow' ORDER BY finished DESC, run DESC LIMIT 1",
    "latest_data_files": f"""WITH {RUNS}, f AS (SELECT run, path, CASE WHEN path LIKE 'out/final_%' THEN 0 WHEN path LIKE 'out/cleaned%' THEN 1 ELSE 2 END AS rank, finished, bytes FROM r WHERE path NOT LIKE '%log%' AND path NOT LIKE '%statistics%'),
      k AS (SELECT run, path, row_number() OVER (PARTITION BY run ORDER BY rank, CASE WHEN rank < 2 THEN epoch_us(finished) ELSE bytes END DESC, path DESC) AS n FROM f) SELECT run, path FROM k WHERE n = 1""",
    "generation_inputs": """SELECT 'k' || o_custkey AS name, 'x' AS scenario, 'v' AS code_value, 2 AS n_callers FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT 'f1', '', 'o' || o_custkey, 0 FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT 'f2', '', 'w', 1 FROM orders WHERE o_orderkey % 3 = 1
      UNION ALL SELECT 'g' || o_orderkey, '', 'z', 0 FROM orders WHERE o_orderkey % 3 = 2""",
}
SQL["cleaning_sample"] = f"SELECT * FROM ({BASE['clean_sql_items']}) ORDER BY record_id, item_pos, reason, content LIMIT 5"

SAMPLES = f"""{AUDIT_FP}, s AS (SELECT user_id, count(*) FILTER (fp NOT IN {EXCLUDED}) AS valid, count(*) FILTER (fp NOT IN {EXCLUDED} AND fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 0)) AS matched FROM f WHERE stmt_id % 2 = 1 GROUP BY 1),
  j AS (SELECT *, CASE WHEN user_id % 10 = 3 THEN 'failed' WHEN matched > 0 THEN 'excellent' WHEN valid > 0 THEN 'good' ELSE 'poor' END AS kind FROM s)"""
SQL |= {
    "table_mentions": f"""WITH i AS (SELECT upper({src.STATEMENT}) AS t FROM lineitem WHERE {src.LISTED} AND ({src.KIND}) = 'STRING'),
      m AS (SELECT 'FROM' AS clause, unnest(regexp_extract_all(t, 'FROM\\s+(\\w+)', 1)) AS "table" FROM i UNION ALL SELECT 'JOIN', unnest(regexp_extract_all(t, 'JOIN\\s+(\\w+)', 1)) FROM i) SELECT clause, "table", count(*) AS n FROM m GROUP BY ALL""",
    "reanalysis_merge": f"""WITH r AS (SELECT o_orderkey AS record_id, ({src.STATE}) AS s FROM orders) SELECT record_id, CASE WHEN s = 'NO_SQL' AND event_id IS NOT NULL THEN 'LIST' ELSE s END AS list_state,
      CASE WHEN s = 'NO_SQL' AND event_id IS NOT NULL THEN 'SELECT a FROM t WHERE id = ' || user_id || '; ## DELETE FROM t;' END AS statements FROM r LEFT JOIN events ON event_id = record_id""",
    "known_sql_types": f"SELECT * FROM ({BASE['sql_type_distribution']}) WHERE sql_type <> 'OTHER'",
    "unmatched_by_type": f"WITH {AUDIT_FP} SELECT {CLASS('sql_text')} AS sql_type, count(*) AS n FROM f WHERE stmt_id % 2 = 1 AND fp NOT IN (SELECT fp FROM f WHERE stmt_id % 2 = 0) GROUP BY 1",
    "sample_classes": f"WITH {SAMPLES} SELECT kind, count(*) AS n, sum(valid)::BIGINT AS valid, sum(matched)::BIGINT AS matched FROM j GROUP BY 1",
    "first_examples": f"WITH {SAMPLES} SELECT kind, user_id FROM j QUALIFY row_number() OVER (PARTITION BY kind ORDER BY user_id) <= 3",
    "branch_replies": f"WITH {LABELLED} SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.8 WHEN 2 THEN 1 WHEN 5 THEN 0.25 ELSE 0 END AS score FROM d",
    "label_counters": f"""WITH l AS ({BASE['condition_labels']}) SELECT count(*) AS total_records, count(*) FILTER (record_id % 2 = 1) AS condition_mapping_records, count(*) FILTER (record_id % 2 = 0) AS other_records,
      count(*) FILTER (record_id % 2 = 0 AND contains(condition, 'if-else')) AS if_else_removed, count(*) FILTER (record_id % 2 = 1 AND contains(condition, 'if-else')) AS if_else_kept, count(*) FILTER (contains(condition, 'keyword')) AS keyword_kept FROM l""",
    "variant_equivalence": "SELECT (o_orderkey % 5 = 0) = (o_orderkey % 10 = 0) AND o_orderkey % 3 <> 0 AND o_custkey % 4 = o_orderkey % 4 AS same, count(*) AS n FROM orders GROUP BY 1",
    "parse_stray_responses": f"WITH {EVENTS} SELECT reply_id, {outcome([x for _, x, _ in said.STRAY])} AS statements FROM p",
    "format_stray_responses": f"WITH {EVENTS} SELECT reply_id, {outcome([x for *_, x in said.STRAY])} AS statements FROM p",
    "validator_errors": f"WITH {EVENTS}, {VERDICTS} SELECT k AS kind, validator, code IS NULL AS valid, code, detail, count(*) AS n FROM p JOIN o ON reply_id % {len(said.VERDICTS)} = k GROUP BY ALL",
    "nested_statements": f"WITH {EVENTS} SELECT reply_id, CASE reply_id % {len(said.NESTED)} {' '.join(f'WHEN {k} THEN {len(x)}' for k, (_, x, _) in enumerate(said.NESTED))} END AS n, {outcome([x for _, x, _ in said.NESTED])} AS statements FROM p",
    "loose_statements": f"WITH {EVENTS}, {each_outcome([x for *_, x in said.NESTED])} SELECT x AS sql_text, count(*) AS n FROM p JOIN o ON reply_id % {len(said.NESTED)} = k GROUP BY x",
    "clause_features": f"WITH {EVENTS}, {CLAUSED} SELECT k AS kind, stmt_type, fp, count(*) AS n, count(DISTINCT user_id) AS n_texts FROM p JOIN o ON reply_id % {len(said.CLAUSED)} = k GROUP BY ALL",
    "clause_names": f"WITH {EVENTS}, {NAMED} SELECT stmt_type, clause, tab AS \"table\", name, count(*) AS n, min(reply_id) AS first FROM p JOIN o ON reply_id % {len(said.CLAUSED)} = k GROUP BY ALL",
}
