"""DuckDB SQL for ``plans.further_queries``, written from the rules."""

from __future__ import annotations

from ..functions import prompts, scenarios, text
from ..sources import lists as raw
from ..sources import replies as said
from ..sources import results
from .oracle import AUDIT_FP, EXCLUDED, HALF_EVEN, ITEM_FP, LISTED, PURE, RECORDS, REWARDS
from .oracle import SQL as BASE

written = said.written
N = len(results.ROWS)
#: The last row of each customer decides; units and left-out statements by the kind of that row.
LATEST = f"s AS (SELECT 's' || o_custkey AS sample_id, max(o_orderkey) % {N} AS k FROM orders GROUP BY o_custkey)"
UNIT_ROWS = "u(k, caller, item, unit, first_sql) AS (VALUES " + ", ".join(f"({k}, {c}, {i}, '{u}', {written(q.strip())})" for k, own in enumerate(results.UNITS) for (c, i), u, q in own) + ")"
LEFT_ROWS = "x(k, sql_text, reason) AS (VALUES " + ", ".join(f"({k}, {written(q)}, '{r}')" for k, own in enumerate(results.LEFT_OUT) for q, r in own) + ")"
CATALOG = f"c AS (SELECT DISTINCT [{', '.join(results.KNOWN_FPS)}][s_suppkey % {len(results.KNOWN)} + 1] AS fp FROM supplier)"
RATE = lambda a, b: f"coalesce(round(({a}) / nullif({b}, 0)::DOUBLE, 6), 0)::DOUBLE"
OFFICIAL = f"[{', '.join(map(str, results.OFFICIAL))}][k + 1]"
#: Which unmatched statements meet the catalog by table, and by type too.
MET = f"(first_sql IN ({written(results.S[2])}, {written(results.S[8])}, {written(results.S[9])}))"
SAME = f"(first_sql = {written(results.S[9])})"

LONG = "SELECT section, metric, key, count(*) AS n, sum(value)::DOUBLE AS total, round(avg(value), 6) AS mean, median(value)::DOUBLE AS median, min(value)::DOUBLE AS least, max(value)::DOUBLE AS most FROM e GROUP BY ALL"


def entries(*parts: str) -> str:
    return "e AS (" + " UNION ALL ".join(f"SELECT {p}" for p in parts) + ")"


STYLE = "CASE WHEN name = 'getUser' THEN 'camelCase' WHEN name LIKE 'GetUser%' THEN 'PascalCase' WHEN name = 'get_user_x' THEN 'snake_case' WHEN name = 'get-user' THEN 'kebab-case' ELSE 'mixed' END"
PROJECT = "regexp_extract(function_name, '(proj\\d+)__', 1)"
JOINED = "CASE WHEN up LIKE '%LEFT JOIN%' THEN 'LEFT JOIN' WHEN up LIKE '%JOIN%' THEN 'SIMPLE JOIN' END"
WORDS = lambda words: "unnest(list_filter([" + ", ".join(f"'{w}'" for w in words) + "], lambda w: contains(orm_code, w)))"
ONE = "1.0::DOUBLE"
DATA = entries(
    f"'metadata' AS section, 'records' AS metric, '' AS key, {ONE} AS value FROM y",
    f"'functions', 'naming', {STYLE}, {ONE} FROM y", "'functions', 'name_length', '', len(name)::DOUBLE FROM y",
    f"'functions', 'prefix', name[:3], {ONE} FROM y WHERE len(name) > 3", f"'functions', 'suffix', right(name, 3), {ONE} FROM y WHERE len(name) > 3",
    "'statements', 'with_statements', '', (n_items > 0)::INT::DOUBLE FROM y", "'statements', 'items', '', n_items::DOUBLE FROM y", "'statements', 'objects', '', (n_items - n_texts)::DOUBLE FROM y",
    f"'projects', 'functions', {PROJECT}, {ONE} FROM y", f"'projects', 'with_statements', {PROJECT}, {ONE} FROM y WHERE n_items > 0", f"'projects', 'items', {PROJECT}, n_items::DOUBLE FROM y",
    f"'projects', 'type', {PROJECT} || '/' || unnest(sql_types), {ONE} FROM y",
    "'code', 'code_length', '', len(orm_code)::DOUBLE FROM y", "'code', 'with_caller', '', (caller <> '')::INT::DOUBLE FROM y",
    f"'code', 'language', 'Go', {ONE} FROM y WHERE orm_code <> ''",  # every method text has func and no import
    f"'code', 'orm_word', {WORDS(text.ORM_WORDS)}, {ONE} FROM y", f"'code', 'error_word', {WORDS(text.ERROR_WORDS)}, {ONE} FROM y",
    *[f"'quality', 'complete', '{f}', ({t})::INT::DOUBLE FROM y" for f, t in (("function_name", "function_name <> ''"), ("orm_code", "orm_code <> ''"), ("statements", "n_items > 0"), ("types", "len(sql_types) > 0"), ("metadata", "code_value <> ''"), ("source_file", "source_file <> ''"))],
    "'quality', 'aligned', '', (n_items > 0 AND len(sql_types) > 0)::INT::DOUBLE FROM y", "'quality', 'name_format', '', (function_name LIKE '%:%' AND function_name LIKE '%/%')::INT::DOUBLE FROM y",
    "'statements', 'length', '', len(sql_text)::DOUBLE FROM t", f"'statements', 'complexity', CASE WHEN regexp_matches(up, 'JOIN|SUBQUERY|UNION|GROUP BY|HAVING') THEN 'complex' ELSE 'simple' END, {ONE} FROM t",
    f"'statements', 'join', {JOINED}, {ONE} FROM t WHERE {JOINED} IS NOT NULL",
    "'statements', 'keyword', unnest(list_filter([" + ", ".join(f"'{k}'" for k in text.ANALYSED_KEYWORDS) + f"], lambda w: contains(up, w))), {ONE} FROM t",
    f"'statements', 'table', unnest(regexp_extract_all(up, 'FROM\\s+(\\w+)', 1) || regexp_extract_all(up, 'JOIN\\s+(\\w+)', 1)), {ONE} FROM t",
)
#: Of each kind of audited statement: class with DDL, complexity score, and pattern flags, by hand.
KIND = """CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN event_type ELSE 'x' || (stmt_id % 10) END"""
TYPE = "CASE k WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'SELECT' WHEN 'purchase' THEN 'UPDATE' WHEN 'signup' THEN 'INSERT' WHEN 'x3' THEN 'DDL' WHEN 'x6' THEN 'SELECT' WHEN 'x7' THEN 'DELETE' WHEN 'x9' THEN 'SELECT' ELSE 'OTHER' END"
LEVEL = "CASE WHEN k = 'click' THEN 'COMPLEX' WHEN k IN ('purchase', 'signup') THEN 'MEDIUM' ELSE 'SIMPLE' END"
FLAGS = """CASE k WHEN 'view' THEN ['HAS_WHERE', 'HAS_LIMIT'] WHEN 'click' THEN ['HAS_JOIN', 'HAS_WHERE', 'HAS_GROUP_BY', 'HAS_ORDER_BY', 'HAS_COUNT'] WHEN 'purchase' THEN ['HAS_WHERE'] WHEN 'x7' THEN ['HAS_WHERE'] WHEN 'x9' THEN ['HAS_WHERE'] ELSE []::VARCHAR[] END"""
SAMPLES = f"""{AUDIT_FP}, cat AS (SELECT DISTINCT fp FROM f WHERE stmt_id % 2 = 0), ev AS (SELECT event_id AS stmt_id, event_type FROM events),
  m AS (SELECT user_id AS sample_id, f.stmt_id, sql_text, fp, fp NOT IN {EXCLUDED} AND fp IN (SELECT fp FROM cat) AS matched, fp NOT IN {EXCLUDED} AS valid, {KIND} AS k FROM f JOIN ev USING (stmt_id) WHERE f.stmt_id % 2 = 1),
  sm AS (SELECT sample_id, count(*) FILTER (valid) AS valid, count(*) FILTER (matched) AS matched, sample_id % 10 <> 3 AS ok FROM m GROUP BY sample_id)"""
PATTERNS = (
    f"'patterns' AS section, 'type' AS metric, {TYPE} AS key, {ONE} AS value FROM m", f"'patterns', 'complexity', {LEVEL}, {ONE} FROM m", "'patterns', 'length', '', len(sql_text)::DOUBLE FROM m", f"'patterns', 'pattern', unnest({FLAGS}), {ONE} FROM m",
    f"'patterns', 'error', CASE WHEN sample_id % 8 = 0 THEN 'JSON_PARSE_ERROR' ELSE 'TIMEOUT_ERROR' END, {ONE} FROM sm WHERE sample_id % 4 = 0",
)
SCORE = "(ok::INT + 1 + (valid > 0)::INT + 2 * (matched > 0)::INT)"
COVERAGE = (
    "'coverage', 'found', '', matched::INT::DOUBLE FROM m", f"'coverage', 'fingerprint', fp, {ONE} FROM m WHERE matched", f"'coverage', 'unmatched_type', {TYPE}, {ONE} FROM m WHERE NOT matched",
    f"'quality', 'score', '', {SCORE}::DOUBLE FROM sm", f"'quality', 'scores', {SCORE}::VARCHAR, {ONE} FROM sm", f"'quality', 'band', CASE WHEN {SCORE} >= 4 THEN 'high' WHEN {SCORE} >= 2 THEN 'medium' ELSE 'low' END, {ONE} FROM sm",
)


def cut(**most: int) -> str:
    return " OR ".join([f"metric NOT IN ({', '.join(repr(m) for m in most)})", *[f"(metric = '{m}' AND place <= {n})" for m, n in most.items()]])


PLACED = f"g AS ({LONG}), h AS (SELECT *, row_number() OVER (PARTITION BY section, metric ORDER BY n DESC, key) AS place FROM g)"
SHOWN = "section, metric, key, n, total, mean, median, least, most"

EVENTS = "p AS (SELECT event_id AS reply_id, event_id, user_id FROM events)"


def by_kind(values: list[str], key: str) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


def joined(texts: list[list[str]]) -> list[str]:
    return [written(" ## ".join(t)) for t in texts]


def text_or_null(s: str | None) -> str:
    return "NULL" if s is None else written(s)


LIST_TEXT = by_kind([written(t) for t in raw.LISTS], "o_orderkey")
FIXED = f"CASE {raw.FIX} WHEN 0 THEN {LIST_TEXT} " + " ".join(f"WHEN {g} THEN {by_kind([text_or_null(t) for t in own], 'o_orderkey')}" for g, own in raw.FIXED.items()) + " END"
SCENARIO = "CASE o_orderkey % 5 WHEN 0 THEN 'mutual_exclusive_conditions' WHEN 1 THEN 'table_name_from_caller' WHEN 2 THEN 'With_First' WHEN 3 THEN 'plain' END"
TASK_TEXT = prompts.TEMPLATES["generate"]
TASK_PROMPT = "replace(replace(replace(" + written(TASK_TEXT) + ", '{code}', code), '{caller}', caller), '{metadata}', 'm1' || chr(10) || 'm2')"
VOTE_ROWS = "v(k, type, ok) AS (VALUES " + ", ".join(f"({k}, '{t}', {t in own})" for k, (_, own) in enumerate(said.VOTES) for t in ("redundant", "new", "missing")) + ")"
LEVELS = "[" + ", ".join(f"'{k}'" for k in scenarios.LEVEL_VARIANTS) + "]"
NAMES = "[" + ", ".join(f"'{k}'" for k in scenarios.SCENARIO_VARIANTS) + "]"
BOUNDS = lambda table, i: "[" + ", ".join(str(b[i]) for b in table.values()) + "]"
DECIDED = f"dd AS ({BASE['redundancy_decisions']})"
#: Verdicts of report replies by kind: 6 is incorrect, 7 correct, all others unreadable; the list after next but one is regenerated for kinds 4 and 6.
NEW_KEY = "coalesce(nullif(array_to_string(sql_types, ','), ''), 'no_sql')"
RL_CONTENT = "replace(replace(replace(" + written(TASK_TEXT) + ", '{code}', orm_code), '{caller}', caller), '{metadata}', '**U**: ' || code_value || CASE WHEN record_id % 2 = 0 THEN ' (文件: u.go)' ELSE '' END)"

SQL: dict[str, str] = {
    "evaluation_summary": f"""WITH {LATEST}, {UNIT_ROWS}, {LEFT_ROWS}, {CATALOG}, a AS (SELECT s.sample_id, unit FROM s JOIN u USING (k)),
      t AS (SELECT count(*) FILTER (unit = 'matched') AS matching, count(*) FILTER (unit IN ('matched', 'unmatched')) AS valid, count(*) FILTER (unit = 'excluded') AS excluded, count(DISTINCT sample_id) FILTER (unit = 'matched') AS matching_samples FROM a),
      o AS (SELECT (SELECT count(*) FROM s JOIN x USING (k) WHERE reason = 'transaction_wrapper') AS wrappers, (SELECT count(*) FROM s) AS samples, (SELECT coalesce(sum({OFFICIAL}), 0)::BIGINT FROM s) AS official,
        (SELECT count(DISTINCT fp) FROM (SELECT unnest(CASE k WHEN 0 THEN [{results.KNOWN_FPS[0]}] WHEN 1 THEN [{results.KNOWN_FPS[0]}, {results.KNOWN_FPS[1]}] ELSE [] END) AS fp FROM s)) AS matched_fps, (SELECT count(*) FROM c) AS catalog_fps)
      SELECT *, {RATE('matching', 'valid')} AS match_rate, {RATE('matched_fps', 'catalog_fps')} AS fp_coverage FROM t, o""",
    "evaluation_units": f"WITH {LATEST}, {UNIT_ROWS} SELECT sample_id, string_agg(caller || '/' || item || ':' || unit, ' ' ORDER BY caller, item) AS units FROM s JOIN u USING (k) GROUP BY sample_id",
    "evaluation_exclusions": f"WITH {LATEST}, {LEFT_ROWS} SELECT reason, count(*) AS n FROM s JOIN x USING (k) WHERE reason <> 'system_function' GROUP BY reason",
    "evaluation_coverage": f"""WITH {LATEST}, {UNIT_ROWS}, t AS (SELECT count(*) FILTER (unit = 'matched') AS matching, count(*) FILTER (unit = 'unmatched') AS unmatched, count(*) FILTER (unit = 'unmatched' AND {MET}) AS table_match,
        count(*) FILTER (unit = 'unmatched' AND {SAME}) AS table_type_match FROM s JOIN u USING (k)), v AS (SELECT *, matching + unmatched AS valid, unmatched - table_match AS no_table FROM t)
      SELECT *, {RATE('matching', '(valid - no_table)')} AS adjusted_rate, {RATE('matching + table_type_match', 'valid')} AS combined_rate, {RATE('matching + table_match', 'valid')} AS table_rate FROM v""",
    "evaluation_lists": f"""WITH {LATEST}, {UNIT_ROWS}, {LEFT_ROWS}, {CATALOG} SELECT unit AS list, first_sql AS sql_text, NULL::VARCHAR AS reason, count(*) AS n FROM s JOIN u USING (k) WHERE unit IN ('matched', 'unmatched') GROUP BY ALL
      UNION ALL SELECT 'excluded', sql_text, reason, count(*) FROM s JOIN x USING (k) WHERE reason <> 'transaction_wrapper' GROUP BY ALL
      UNION ALL SELECT 'invalid', NULL, fp, 1 FROM c WHERE fp IN {EXCLUDED}""",
    "data_report": f"""WITH {LISTED}, w AS (SELECT record_id, count(*) AS n_texts FROM i WHERE item_kind = 'STRING' AND sql_text <> '' GROUP BY record_id), y AS (SELECT z.*, {PURE} AS name, coalesce(n_texts, 0) AS n_texts FROM z LEFT JOIN w USING (record_id)),
      t AS (SELECT sql_text, upper(sql_text) AS up FROM i JOIN r USING (record_id) WHERE item_kind = 'STRING' AND sql_text <> ''), {DATA}, {PLACED}
      SELECT {SHOWN} FROM h WHERE {cut(prefix=10, suffix=10)} UNION ALL SELECT 'functions', 'unique_names', '', count(DISTINCT name), count(DISTINCT name)::DOUBLE, NULL, NULL, NULL, NULL FROM y""",
    "pattern_analysis": f"WITH {SAMPLES}, {entries(*PATTERNS)}, {PLACED} SELECT {SHOWN} FROM h WHERE {cut(pattern=6)}",
    "evaluation_report": f"""WITH {SAMPLES}, {entries(*PATTERNS, *COVERAGE)}, {PLACED},
      q AS (SELECT sample_id, CASE WHEN NOT ok THEN 'failed' WHEN matched > 0 THEN 'excellent' WHEN valid > 0 THEN 'good' ELSE 'poor' END AS class FROM sm)
      SELECT {SHOWN} FROM h WHERE {cut(pattern=3, fingerprint=3)}
      UNION ALL SELECT 'examples', class, sample_id::VARCHAR, 1, 1.0, NULL, NULL, NULL, NULL FROM q QUALIFY row_number() OVER (PARTITION BY class ORDER BY sample_id) <= 4""",
    "simple_responses": f"WITH {EVENTS} SELECT reply_id, {by_kind(joined([x for _, x in said.SIMPLE]), 'reply_id')} AS statements FROM p",
    "prose_statements": f"WITH {EVENTS} SELECT reply_id, {by_kind(joined([x for _, x in said.PROSE]), 'reply_id')} AS statements FROM p",
    "penalty_severities": f"WITH {EVENTS} SELECT reply_id, {by_kind([f'{x}::DOUBLE' for _, x in said.SEVERITIES], 'reply_id')} AS severity FROM p",
    "evaluation_log": f"""WITH d AS (SELECT DISTINCT doc_id FROM labels) SELECT doc_id, left(md5('s' || doc_id || CASE WHEN doc_id % 2 = 0 THEN 't' || doc_id ELSE '' END), 8) AS content_hash,
      CASE WHEN doc_id % 3 = 0 THEN 1.0 ELSE {HALF_EVEN('(doc_id % 7) / 7.0::DOUBLE', 3)} END AS expect, {HALF_EVEN('(doc_id % 16) / 16.0::DOUBLE', 3)} AS steps, {HALF_EVEN('(doc_id % 5) / 5.0::DOUBLE', 3)} AS instruction, {HALF_EVEN('(doc_id % 9) / 9.0::DOUBLE', 3)} AS final, 0.3::DOUBLE AS expect_weight FROM d""",
    "fix_raw_lists": f"SELECT * FROM (SELECT o_orderkey AS record_id, {FIXED} AS statement_list, {raw.FIX} > 0 AS touched FROM orders) WHERE statement_list IS NOT NULL",
    "no_sql_forms": f"WITH k AS (SELECT o_orderkey % {len(raw.SENTINELS)} AS k FROM orders) SELECT " + ", ".join(f"count(*) FILTER ({[x[i] for _, x in raw.SENTINELS]}[k + 1] = 1) AS {n}" for i, n in enumerate(("one", "two", "three"))) + ", count(*) AS records FROM k",
    "incomplete_statements": f"SELECT o_orderkey AS record_id, {by_kind([written(x) for _, x in raw.GAPS], 'o_orderkey')} AS statement_list FROM orders",
    "list_patterns": f"SELECT DISTINCT unnest({by_kind([str(x) + '::VARCHAR[]' for _, x in raw.PATTERNS], 'o_orderkey')}) AS pattern FROM orders",
    "variant_lines": f"SELECT o_orderkey AS record_id, {by_kind([written(x) for _, x in raw.LINES], 'o_orderkey')} AS lines FROM orders",
    "pruned_examples": f"SELECT o_orderkey AS record_id, {by_kind([written(x) for _, x in raw.EXAMPLES], 'o_orderkey')} AS example FROM orders",
    "rl_records": f"""WITH {RECORDS}, {ITEM_FP}, n AS (SELECT *, CASE WHEN fp IN ('not_sql', 'invalid_sql') THEN []::VARCHAR[] ELSE CASE k % 6 WHEN 0 THEN ['part' || (k % 4)] WHEN 1 THEN ['part' || (k % 4)] WHEN 2 THEN ['log' || (k % 3)] WHEN 3 THEN ['line' || (k % 4)] WHEN 4 THEN ['a' || (k % 5), 'b'] ELSE ['c'] END END AS t,
        CASE WHEN fp IN ('not_sql', 'invalid_sql') THEN []::VARCHAR[] ELSE CASE k % 6 WHEN 0 THEN ['id'] WHEN 1 THEN ['id', 'qty'] WHEN 2 THEN ['a', 'b'] WHEN 3 THEN ['id'] WHEN 4 THEN ['aid', 'id', 'x'] ELSE []::VARCHAR[] END END AS c FROM fi),
      g AS (SELECT record_id, list_sort(list_distinct(flatten(list(t)))) AS tables, list_sort(list_distinct(flatten(list(c)))) AS columns, coalesce(list(sql_text ORDER BY item_pos, variant_pos, sql_text) FILTER (item_kind = 'STRING'), []) AS statements FROM n GROUP BY record_id)
      SELECT record_id, 'code2sql_orm' AS data_source, 'code_generation' AS ability, 'user' AS role, {RL_CONTENT} AS content, 'rule' AS style, to_json(statements)::VARCHAR AS ground_truth, 'train' AS split, array_to_string(tables, ',') AS pre_tables, array_to_string(columns, ',') AS pre_columns, source_file
      FROM r JOIN g USING (record_id) WHERE orm_code <> '' AND record_id % 13 <> 0 AND len(tables) + len(columns) > 0""",
    "caller_tasks": f"""WITH o AS (SELECT 'f' || o_orderkey AS name, coalesce({SCENARIO}, '') AS s, CASE WHEN o_custkey % 3 = 0 THEN 'v' || o_custkey WHEN o_custkey % 3 = 1 THEN 'orm' END AS code, o_custkey % 5 AS sql_pattern_cnt,
        CASE WHEN o_orderkey % 4 = 0 THEN [] ELSE ['c1', 'c2'][:(o_orderkey % 4 - 1)] END AS callers FROM orders WHERE o_custkey % 3 < 2),
      t AS (SELECT *, name || '_no_caller' AS task, '' AS caller FROM o WHERE s NOT IN ('mutual_exclusive_conditions', 'table_name_from_caller') UNION ALL SELECT name, s, code, sql_pattern_cnt, callers, name || '_caller_' || (substr(caller, 2)::INT - 1), caller FROM (SELECT *, unnest(callers) AS caller FROM o) x(name, s, code, sql_pattern_cnt, callers, caller)),
      q AS (SELECT *, {TASK_PROMPT} || CASE WHEN s = 'With_First' THEN 'Rule: LIMIT 1' ELSE '' END AS prompt FROM t)
      SELECT name, task, caller, md5(prompt) AS prompt_md5, s = 'With_First' AS has_rule, true AS has_metadata, sql_pattern_cnt FROM q""",
    "type_strata": f"WITH {LISTED}, q AS (SELECT {NEW_KEY} AS types, count(*) AS size FROM z GROUP BY 1) SELECT types, size, greatest(1, floor(size * 500.0 / (SELECT count(*) FROM z)))::BIGINT AS quota FROM q",
    "type_strata_sample": f"WITH {LISTED} SELECT least(500, count(*)) AS n, count(DISTINCT {NEW_KEY}) AS n_types FROM z",
    "case_bounds": f"""WITH o AS (SELECT o_orderkey % {len(scenarios.SCENARIO_VARIANTS)} + 1 AS i, o_custkey % {len(scenarios.LEVEL_VARIANTS)} + 1 AS j FROM orders),
      b AS (SELECT {NAMES}[i] AS scenario, {LEVELS}[j] AS level, {BOUNDS(scenarios.SCENARIO_VARIANTS, 0)}[i] AS a, {BOUNDS(scenarios.SCENARIO_VARIANTS, 1)}[i] AS b, {BOUNDS(scenarios.LEVEL_VARIANTS, 0)}[j] AS c, {BOUNDS(scenarios.LEVEL_VARIANTS, 1)}[j] AS d FROM o)
      SELECT scenario, level, CASE WHEN greatest(a, c) > least(b, d) THEN a ELSE greatest(a, c) END AS least, CASE WHEN greatest(a, c) > least(b, d) THEN b ELSE least(b, d) END AS most, count(*) AS n FROM b GROUP BY ALL""",
    "fix_recommendations": f"""WITH {DECIDED}, l AS (SELECT CASE WHEN type = 'redundant' AND decision = 'remove' THEN 'remove_redundant' WHEN type = 'new' AND decision = 'remove' THEN 'remove_wrong_new' WHEN type = 'missing' AND decision = 'add' THEN 'add_missing' ELSE 'keep_disputed' END AS list FROM dd)
      SELECT x AS list, (SELECT count(*) FROM l WHERE l.list = x OR x = 'total_candidates') AS n FROM (SELECT unnest(['remove_redundant', 'remove_wrong_new', 'add_missing', 'keep_disputed', 'total_candidates']) AS x)""",
    "validation_by_part": f"""WITH {DECIDED}, q AS (SELECT candidate % 64 AS part, decision FROM dd WHERE candidate % 64 % 3 <> 1), a AS (SELECT DISTINCT o_orderkey % 64 AS part FROM orders)
      SELECT a.part, count(decision) AS candidates, count(*) FILTER (decision = 'remove') AS removed, count(*) FILTER (decision = 'add') AS added, count(*) FILTER (decision = 'keep') AS kept FROM a LEFT JOIN q ON q.part = a.part GROUP BY a.part""",
    "control_flow_outcomes": """WITH v AS (SELECT event_id % 10 AS k, event_id IN (SELECT event_id - 3 FROM events WHERE event_id % 10 IN (7, 9)) AS again FROM events)
      SELECT count(*) AS detected, count(*) FILTER (k = 7) AS correct, count(*) FILTER (k = 6) AS incorrect, count(*) FILTER (k NOT IN (6, 7)) AS error, count(*) FILTER (k = 6 AND again) AS regenerated, coalesce(round(count(*) FILTER (k = 7) / nullif(count(*), 0)::DOUBLE, 6), 0)::DOUBLE AS rate FROM v""",
    "reanalysis_outcomes": """WITH x AS (SELECT o_orderkey % 7 = 0 AS failed, o_orderkey % 5 = 0 AS skipped, o_custkey % 6 < 2 AS new FROM orders)
      SELECT count(*) AS processed, count(*) FILTER (failed) AS failed, count(*) FILTER (NOT failed) AS succeeded, count(*) FILTER (NOT failed AND skipped) AS skipped, count(*) FILTER (NOT failed AND NOT skipped) AS analysed,
        count(*) FILTER (NOT failed AND NOT skipped AND new) AS newly_generated, count(*) FILTER (NOT failed AND NOT skipped AND NOT new) AS still_without FROM x""",
    "flat_summary": """WITH o(k, metric, value) AS (VALUES (0, 'x', '1'), (0, 'y', 'z'), (0, 'b', '3'), (1, 'x', '9'), (1, 'c', 'null'), (2, 'summary', 'text')) SELECT c_custkey AS record_id, metric, value FROM customer JOIN o ON c_custkey % 4 = k""",
    "judged_votes": f"""WITH {VOTE_ROWS}, e AS (SELECT event_id % 300 AS candidate, ['redundant', 'new', 'missing'][event_id % 300 % 3 + 1] AS type, (event_id // 7) % {len(said.VOTES)} AS k FROM events),
      c AS (SELECT candidate, type, count(*) AS n, count(*) FILTER (ok) AS confirmed FROM e JOIN v USING (k, type) GROUP BY ALL)
      SELECT *, CASE type WHEN 'redundant' THEN CASE WHEN confirmed >= 0.6::DOUBLE * n THEN 'remove' ELSE 'keep' END WHEN 'new' THEN CASE WHEN confirmed >= 0.6::DOUBLE * n THEN 'keep' ELSE 'remove' END ELSE CASE WHEN confirmed >= 0.6::DOUBLE * n THEN 'add' ELSE 'keep' END END AS decision FROM c""",
    "mapping_records": """WITH n AS (SELECT *, 'm' || n_regionkey AS mapping, n_regionkey < 3 AND n_nationkey % 2 = 1 AS generated FROM nation), k AS (SELECT * FROM n WHERE generated OR mapping NOT IN (SELECT mapping FROM n WHERE generated))
      SELECT mapping, n_nationkey::BIGINT AS nation, NULL::BIGINT AS extra FROM k UNION ALL SELECT mapping, NULL, n_nationkey FROM k WHERE n_nationkey % 3 = 0""",
    "folder_head": "SELECT row_number() OVER (ORDER BY n_regionkey, n_nationkey) - 1 AS number, n_nationkey::BIGINT AS nation FROM nation QUALIFY number < 12",
    "report_folders": "WITH n AS (SELECT 'run' || (n_nationkey // 2) AS run, n_nationkey % 3 AS k FROM nation WHERE n_nationkey % 3 < 2) SELECT run, CASE WHEN min(k) = 0 THEN 'statistics_summary.json' ELSE 'evaluation_summary.json' END AS report FROM n GROUP BY run",
    "reward_lines": "WITH e AS (SELECT (event_id % 30)::INT AS log, event_id % 5 AS k, row_number() OVER (PARTITION BY event_id % 30 ORDER BY event_id) AS line_number FROM events) SELECT log, line_number, CASE k WHEN 0 THEN 0.9::DOUBLE ELSE 0.45 END AS score, CASE k WHEN 0 THEN '0.8-1.0' ELSE '0.4-0.6' END AS band FROM e WHERE k IN (0, 4)",
    "field_sides": "SELECT * FROM (VALUES ('id', 'both'), ('a', 'both'), ('c', 'both'), ('b', 'right')) t(field, side) WHERE (SELECT count(DISTINCT o_orderkey % 4) FROM orders) = 4",
    "dataset_size": f"WITH {RECORDS} SELECT count(*) AS records, sum(len('{{\"record_id\":' || record_id || ',\"caller\":\"' || caller || '\",\"pattern_cnt\":' || pattern_cnt || '}}'))::BIGINT AS characters FROM r",
    "root_shapes": "WITH o(k, pos, n) AS (VALUES (0, 0, 1), (0, 1, 2), (1, 0, 3), (2, 0, 4), (2, 1, 5), (2, 2, 6), (4, 0, 7), (5, 0, 8)) SELECT 'f' || o_orderkey AS source, pos, n FROM orders JOIN o ON o_orderkey % 8 = k",
    "mapped_rows": "SELECT 'f' || o_orderkey AS source, 'a' || o_custkey AS sample_id, o_orderkey AS n FROM orders UNION ALL SELECT 'f' || o_orderkey, 'b', 1 FROM orders",
    "input_warnings": "WITH o(k, item, problem) AS (VALUES (0, 'g', 'no_code'), (1, '1', 'not_an_object'), (1, '2', 'no_code'), (2, NULL, 'wrong_root'), (3, NULL, 'unreadable'), (5, 'h', 'no_code')) SELECT 'f' || o_orderkey AS source, item, problem FROM orders JOIN o ON o_orderkey % 6 = k",
    "keyword_status": f"""WITH {RECORDS}, e AS (SELECT event_id AS record_id, event_id % 5 AS k FROM events)
      SELECT record_id, CASE k WHEN 0 THEN 'Preload|save' WHEN 3 THEN 'Scopes|Pluck' WHEN 4 THEN 'Hooks' ELSE '' END AS keywords, coalesce(k IN (0, 3, 4), false) AS has_keywords, CASE WHEN k IS NULL OR k = 2 THEN 'failed' ELSE 'ok' END AS status FROM r LEFT JOIN e USING (record_id)""",
    "prompt_layouts": """WITH o AS (SELECT o_orderkey, o_custkey AS c, chr(10) AS n FROM orders) SELECT o_orderkey, 'k' || n || c || n || n || 'l' || n || 'w' AS plain, '1. k: ' || c || n || n || '2. l: w' AS numbered, '// f.go' || n || c AS files,
      '```' || n || c || n || '```' || n || n || '```' || n || 'w' || n || '```' AS fenced, c || n || n || 'w' AS values, '**k**: ' || c || ' (文件: f.go)' || n || '**l**: w' AS rl, '**k**:' || n || c || n || '(文件: f.go)' || n || n || '**l**:' || n || 'w' AS sft FROM o""",
    "reward_by_settings": "WITH " + REWARDS + ", x AS (SELECT doc_id, CASE WHEN keyword IS NULL THEN (0.5::DOUBLE * validity + 0.25::DOUBLE * consistency) / 0.75::DOUBLE ELSE 0.5::DOUBLE * validity + 0.25::DOUBLE * consistency + 0.25::DOUBLE * keyword END - 0.125::DOUBLE * least(severity, 1) AS v FROM w) SELECT doc_id, " + HALF_EVEN("greatest(least(v, 1), 0)", 2) + " AS reward FROM x",
    "metadata_parts": f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN {written('1. 文件: f | 行号: 1-2 | 键: k | 值: v | 标签: 3 | 类型: 0' + chr(10) + '2. 键: None' + chr(10) + '3. x' + chr(10) + '4. ')} ELSE '无代码元数据' END AS text FROM orders",
}
