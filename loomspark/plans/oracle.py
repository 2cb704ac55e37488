"""DuckDB SQL for the queries of ``plans.queries``, written from the rules, not from the Spark code.

Where a query fingerprints statements, the SQL names the features of each
statement template by hand and hashes them, so the parser is checked too.
"""

from __future__ import annotations

from ..functions import text
from ..sources import adapters as src

AUDIT = f"a AS (SELECT event_id AS stmt_id, user_id, ({src.AUDIT}) AS sql_text, event_type FROM events)"
#: Fingerprints by template: the type of an event tells the features.
AUDIT_FP = f"""{AUDIT}, f AS (SELECT stmt_id, user_id, sql_text, CASE event_type
  WHEN 'view' THEN md5('type_1.tables_User' || (user_id % 5) || CASE stmt_id % 8 WHEN 2 THEN '_old' WHEN 3 THEN '_new' ELSE '_items' END || '.predicates_user_id_value')
  WHEN 'click' THEN md5('type_1.tables_orders_users' || (user_id % 3) || '.predicates_age_id_status_uid_vip.has_group_by.has_having')
  WHEN 'purchase' THEN md5('type_3.tables_stock' || (user_id % 4) || '.where_columns_item_id_shop_id')
  WHEN 'signup' THEN md5('type_2.tables_accounts' || (user_id % 3) || '.predicates_')
  ELSE CASE stmt_id % 10 WHEN 0 THEN 'transaction_end' WHEN 1 THEN 'show_command' WHEN 2 THEN 'session_setting' WHEN 3 THEN 'ddl_command' WHEN 6 THEN 'system_function_now'
    WHEN 7 THEN md5('type_4.tables_sessions.predicates_token') WHEN 9 THEN 'invalid_sql' ELSE 'not_sql' END END AS fp,
  CASE event_type WHEN 'view' THEN ['User' || (user_id % 5) || CASE stmt_id % 8 WHEN 2 THEN '_old' WHEN 3 THEN '_new' ELSE '_items' END] WHEN 'click' THEN ['orders', 'users' || (user_id % 3)] WHEN 'purchase' THEN ['stock' || (user_id % 4)] WHEN 'signup' THEN ['accounts' || (user_id % 3)]
    ELSE CASE WHEN stmt_id % 10 = 7 THEN ['sessions'] ELSE []::VARCHAR[] END END AS tables,
  CASE event_type WHEN 'view' THEN ['id', 'name', 'user_id', 'value'] WHEN 'click' THEN ['age', 'id', 'status', 'uid', 'vip'] WHEN 'purchase' THEN ['item_id', 'note', 'qty', 'shop_id'] WHEN 'signup' THEN ['id', 'name']
    ELSE CASE WHEN stmt_id % 10 = 7 THEN ['token'] ELSE []::VARCHAR[] END END AS columns
  FROM a)"""
EXCLUDED = "('" + "', '".join(text.EXCLUDED) + "')"
RECORDS = "r AS (SELECT " + ", ".join(f"({e}) AS {n}" for n, e in src.RECORD.items()) + " FROM orders)"
LINES = "l AS (SELECT " + ", ".join(f"({e}) AS {n}" for n, e in src.ITEM.items()) + f", l_suppkey AS k, l_partkey AS p FROM lineitem WHERE {src.LISTED})"
ITEMS = f"{LINES}, i AS (SELECT * REPLACE (CASE WHEN v = 1 THEN sql_text || ' LIMIT 1' ELSE sql_text END AS sql_text), v AS variant_pos FROM l, (SELECT unnest([0, 1])::INT AS v) WHERE v = 0 OR item_kind = 'PARAM_DEPENDENT')"
ITEM_FP = f"""{ITEMS}, fi AS (SELECT *, CASE WHEN p % 10 IN (1, 2) THEN 'not_sql' ELSE CASE k % 6
  WHEN 0 THEN md5('type_1.tables_part' || (k % 4) || '.predicates_id') WHEN 1 THEN md5('type_3.tables_part' || (k % 4) || '.where_columns_id')
  WHEN 2 THEN CASE WHEN v = 1 THEN 'invalid_sql' ELSE md5('type_2.tables_log' || (k % 3) || '.predicates_') END WHEN 3 THEN md5('type_4.tables_line' || (k % 4) || '.predicates_id')
  WHEN 4 THEN md5('type_1.tables_a' || (k % 5) || '_b.predicates_aid_id_x') ELSE md5('type_1.tables_c.predicates_.has_group_by.has_having') END END AS fp
  FROM i WHERE sql_text <> '')"""
STATEMENTS = f"{RECORDS}, {ITEM_FP}, s AS (SELECT record_id, orm_code, caller, item_pos, variant_pos, sql_text, fp, record_id * 16 + item_pos + variant_pos AS seen FROM fi JOIN r USING (record_id))"
SETS = f"""{STATEMENTS}, c AS (SELECT orm_code, caller, list_sort(list(DISTINCT fp)) AS fps, count(*) AS n_sql, min(seen) AS first_seen, count(DISTINCT fp)::INT AS n_fp FROM s WHERE trim(orm_code) <> '' GROUP BY ALL),
  ref AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY orm_code ORDER BY n_fp DESC, n_sql DESC, first_seen, caller) = 1),
  d AS (SELECT c.orm_code, c.caller, ref.caller AS reference, c.first_seen, list_sort(list_intersect(c.fps, ref.fps)) AS common,
          list_sort(list_filter(ref.fps, lambda x: NOT list_contains(c.fps, x))) AS missing, list_sort(list_filter(c.fps, lambda x: NOT list_contains(ref.fps, x))) AS extra
        FROM c JOIN ref ON c.orm_code = ref.orm_code AND c.caller <> ref.caller)"""
CANDIDATES = f"""{SETS}, q AS (SELECT orm_code, caller, 'redundant' AS type, 0 AS place, common AS fps, first_seen FROM d WHERE len(extra) = 0 AND len(missing) > 0
  UNION ALL SELECT orm_code, caller, 'new', 1, extra, first_seen FROM d WHERE len(extra) > 0 UNION ALL SELECT orm_code, caller, 'missing', 2, missing, first_seen FROM d WHERE len(missing) > 0)"""
CLASS = lambda c: f"CASE WHEN upper(trim({c})) LIKE 'SELECT%' THEN 'SELECT' WHEN upper(trim({c})) LIKE 'INSERT%' THEN 'INSERT' WHEN upper(trim({c})) LIKE 'UPDATE%' THEN 'UPDATE' WHEN upper(trim({c})) LIKE 'DELETE%' THEN 'DELETE' ELSE 'OTHER' END"
LISTED = f"{RECORDS}, {ITEMS}, n AS (SELECT record_id, count(DISTINCT item_pos) AS n_items, list_sort(list(DISTINCT {CLASS('sql_text')})) AS sql_types FROM i GROUP BY record_id), z AS (SELECT r.*, coalesce(n_items, 0) AS n_items, coalesce(sql_types, []) AS sql_types FROM r LEFT JOIN n USING (record_id))"
VALID = "regexp_matches(upper({0}), '" + "|".join((*text.SQL_KEYWORDS, *text.SQL_FRAGMENTS)) + "')"
CJK = "regexp_matches(sql_text, '[\\x{4e00}-\\x{9fff}]')"
REASON = f"CASE WHEN item_kind = 'PARAM_DEPENDENT' THEN NULL WHEN item_kind = 'STRING' AND {CJK} THEN 'cjk' WHEN item_kind = 'STRING' AND trim(sql_text) <> '' AND {VALID.format('sql_text')} THEN NULL ELSE 'not_sql' END"
JUDGED = f"{RECORDS}, {ITEMS}, j AS (SELECT *, {REASON} AS reason FROM i)"
CLEANED = f"""{JUDGED}, k AS (SELECT record_id, list(sql_text ORDER BY item_pos, variant_pos, sql_text) AS statements FROM j WHERE reason IS NULL GROUP BY record_id),
  cl AS (SELECT record_id, CASE WHEN list_state = 'LACK_INFO' THEN 'LACK_INFO' WHEN statements IS NULL THEN 'NO_SQL' ELSE 'LIST' END AS list_state, coalesce(statements, []) AS statements FROM r LEFT JOIN k USING (record_id))"""
REPLIES = f"p AS (SELECT event_id AS reply_id, user_id, ({src.REPLY}) AS reply FROM events)"
TAGGED = f"{REPLIES}, {RECORDS}, x AS (SELECT r.*, coalesce(reply, '') AS reply, reply AS raw FROM r LEFT JOIN p ON reply_id = record_id)"
KEYWORDS = "list_sort(list_filter([" + ", ".join(f"'{k}'" for k in text.GORM_KEYWORDS) + "], lambda w: contains(code_value, w) OR contains(orm_code, w)))"
PARSED = """CASE reply_id % 9 WHEN 0 THEN ['SELECT a FROM t WHERE id = ' || user_id || ';', 'DELETE FROM t;'] WHEN 1 THEN ['UPDATE s SET a = ' || user_id || ';'] WHEN 2 THEN ['INSERT INTO k VALUES (' || (user_id % 10) || ');']
  WHEN 3 THEN ['SELECT x FROM y' || (user_id % 5) || ';'] WHEN 5 THEN []::VARCHAR[] ELSE [reply] END"""
PURE = "regexp_extract(function_name, '([^:]*)$', 1)"
DECISIONS = f"""{RECORDS}, dr AS (SELECT * FROM r WHERE record_id % 5 = 3 AND list_state = 'LIST' AND orm_code <> ''),
  gone AS (SELECT DISTINCT orm_code, caller, 'DELETE FROM line1 WHERE id IN (1, 2)' AS sql_text FROM dr WHERE record_id % 3 <> 0),
  more AS (SELECT DISTINCT orm_code, caller, 'SELECT 1' AS sql_text FROM dr WHERE record_id % 3 <> 0 UNION SELECT orm_code, caller, 'SELECT 2' FROM dr WHERE record_id % 6 = 0)"""
EVALUATED = f"""{AUDIT_FP}, cat AS (SELECT DISTINCT fp FROM f WHERE stmt_id % 2 = 0),
  ev AS (SELECT user_id, count(*) AS n, count(*) FILTER (fp NOT IN {EXCLUDED}) AS valid, count(*) FILTER (fp NOT IN {EXCLUDED} AND fp IN (SELECT fp FROM cat)) AS matched FROM f WHERE stmt_id % 2 = 1 GROUP BY user_id),
  qs AS (SELECT *, (1 + (n > 0)::INT + (valid > 0)::INT + 2 * (matched > 0)::INT)::INT AS score FROM ev)"""
REWARDS = """w AS (SELECT doc_id, (doc_id % 8) / 8.0::DOUBLE AS validity, (doc_id % 5) / 5.0::DOUBLE AS consistency, CASE WHEN max(toxic) = 1 THEN (doc_id % 3) / 3.0::DOUBLE END AS keyword,
  (doc_id % 7) / 7.0::DOUBLE AS branch, (doc_id % 4) / 4.0::DOUBLE * max(quality) AS severity FROM labels GROUP BY doc_id)"""



def HALF_EVEN(x: str, digits: int) -> str:
    """Rounds half to even in whole numbers, after rounding at six decimals."""
    n, unit = f"round(({x}) * 1000000)::BIGINT", 10 ** (6 - digits)
    return f"((({n}) // {unit} + CASE WHEN ({n}) % {unit} > {unit // 2} OR ({n}) % {unit} = {unit // 2} AND (({n}) // {unit}) % 2 = 1 THEN 1 ELSE 0 END) / {10**digits}.0)::DOUBLE"


V2 = HALF_EVEN("greatest(least(CASE WHEN keyword IS NULL THEN (0.3::DOUBLE * validity + 0.2::DOUBLE * consistency) / 0.5::DOUBLE ELSE 0.3::DOUBLE * validity + 0.2::DOUBLE * consistency + 0.5::DOUBLE * keyword END - 0.3::DOUBLE * least(severity, 1), 1), 0)", 2)
JACCARD = lambda a, b: f"CASE WHEN len(list_distinct({a} || {b})) = 0 THEN 0 ELSE len(list_intersect({a}, {b})) / len(list_distinct({a} || {b}))::DOUBLE END"
JOINED = "array_to_string({0}, '{1}')"

SQL = {
    "fingerprint_coverage": f"WITH {AUDIT_FP}, c AS (SELECT DISTINCT fp FROM f WHERE stmt_id % 2 = 0 AND fp NOT IN {EXCLUDED}) SELECT count(*) AS valid_catalog, count(*) FILTER (fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 1)) AS valid_matched, coalesce(count(*) FILTER (fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 1)) / nullif(count(*), 0), 0)::DOUBLE AS coverage FROM c",
    "fingerprint_class_counts": f"WITH {AUDIT_FP} SELECT fp, count(*) AS n, fp IN {EXCLUDED} AS excluded FROM f GROUP BY fp",
    "normalize_sql": f"""WITH {AUDIT} SELECT stmt_id, CASE event_type
      WHEN 'view' THEN regexp_replace(regexp_replace(sql_text, 'user_id = \\d+', 'user_id = N'), 'LIMIT \\d+', 'LIMIT N')
      WHEN 'click' THEN 'SELECT o.id, COUNT(*) FROM orders o JOIN Users' || (user_id % 3) || ' u ON o.uid = u.id WHERE o.status = ''S'' AND (u.age >= N OR u.vip IN (N)) GROUP BY o.id HAVING COUNT(*) > 1 ORDER BY o.id'
      WHEN 'purchase' THEN 'UPDATE Stock' || (user_id % 4) || ' SET qty = N, note = "S" WHERE item_id = N AND shop_id IN (N)'
      WHEN 'signup' THEN 'INSERT INTO Accounts' || (user_id % 3) || ' (id, name) VALUES (' || stmt_id || ', ''S'')'
      ELSE CASE WHEN stmt_id % 10 = 7 THEN 'DELETE FROM Sessions WHERE token LIKE ''S''' ELSE sql_text END END AS normal FROM a""",
    "system_function_probe": f"WITH {AUDIT} SELECT 'now' AS name, count(*) AS n FROM a WHERE sql_text = 'SELECT NOW()' HAVING count(*) > 0",
    "looks_like_sql": f"WITH {AUDIT} SELECT NOT (sql_text LIKE 'please%' OR sql_text LIKE '查询%' OR sql_text LIKE 'BEGIN;%') AS is_sql, count(*) AS n FROM a GROUP BY 1",
    "catalog_build": f"WITH {AUDIT_FP} SELECT fp, count(*) AS n_sql, count(DISTINCT sql_text) AS n_texts, arg_min(sql_text, stmt_id) AS first_sql FROM f GROUP BY fp",
    "catalog_match_pairs": f"WITH {AUDIT_FP} SELECT stmt_id, fp, fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 0) AS in_catalog FROM f WHERE stmt_id % 2 = 1",
    "catalog_match_summary": f"""WITH {ITEM_FP}, cat AS (SELECT DISTINCT fp FROM fi WHERE record_id % 2 = 0),
      u AS (SELECT record_id, item_pos, CASE WHEN bool_and(fp IN {EXCLUDED}) THEN 'excluded' WHEN bool_or(fp IN (SELECT fp FROM cat)) THEN 'matched' ELSE 'unmatched' END AS unit FROM fi WHERE record_id % 2 = 1 GROUP BY ALL)
      SELECT 0::BIGINT AS wrappers, count(*) FILTER (unit = 'excluded') AS excluded, count(*) FILTER (unit = 'matched') AS matched, count(*) FILTER (unit <> 'excluded') AS valid,
        (SELECT count(DISTINCT record_id) FROM u WHERE unit = 'matched') AS matching_lines, coalesce(count(*) FILTER (unit = 'matched') / nullif(count(*) FILTER (unit <> 'excluded'), 0), 0)::DOUBLE AS match_rate FROM u""",
    "match_single": f"""WITH {AUDIT_FP}, c AS (SELECT fp, arg_min(sql_text, stmt_id) AS example_sql, count(*) AS n FROM f WHERE stmt_id % 2 = 0 GROUP BY fp)
      SELECT stmt_id, f.fp, c.fp IS NOT NULL AS matched, example_sql, coalesce(n, 0) AS example_count, f.fp IN {EXCLUDED} AS excluded FROM f LEFT JOIN c ON f.fp = c.fp WHERE stmt_id % 2 = 1""",
    "unmatched_fingerprints": f"WITH {AUDIT_FP} SELECT fp, arg_min(sql_text, stmt_id) AS first_sql FROM f WHERE stmt_id % 2 = 0 AND fp NOT IN {EXCLUDED} AND fp NOT IN (SELECT fp FROM f WHERE stmt_id % 2 = 1) GROUP BY fp",
    "coverage_by_type": f"""WITH {AUDIT_FP}, c AS (SELECT fp, {CLASS('arg_min(sql_text, stmt_id)')} AS t FROM f WHERE stmt_id % 2 = 0 AND fp NOT IN {EXCLUDED} GROUP BY fp), m AS (SELECT t, fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 1) AS hit FROM c)
      SELECT t AS sql_type, count(*) AS total, count(*) FILTER (hit) AS matched, count(*) FILTER (hit) / count(*)::DOUBLE AS coverage FROM m GROUP BY t
      UNION ALL SELECT 'ALL', count(*), count(*) FILTER (hit), count(*) FILTER (hit) / nullif(count(*), 0)::DOUBLE FROM m""",
    "table_name_fallback": f"""WITH {AUDIT_FP}, t AS (SELECT stmt_id, user_id, {CLASS('sql_text')} AS ty, tables, unnest(tables) AS tb, generate_subscripts(tables, 1) AS pos FROM f),
      known AS (SELECT tb, ty, min(stmt_id) AS seen FROM t WHERE stmt_id % 2 = 0 GROUP BY ALL)
      SELECT t.stmt_id, t.tb AS "table", t.ty = known.ty AS same_type FROM t JOIN known ON t.tb = known.tb WHERE stmt_id % 2 = 1
      QUALIFY row_number() OVER (PARTITION BY stmt_id ORDER BY pos, (t.ty = known.ty) DESC, seen) = 1""",
    "tables_per_fingerprint": f"WITH {AUDIT_FP}, k AS (SELECT fp, tables, row_number() OVER (PARTITION BY fp ORDER BY stmt_id) AS k FROM f) SELECT fp, list_sort(list_distinct(flatten(list(tables)))) AS tables FROM k WHERE k <= 10 GROUP BY fp",
    "table_frequency": f'WITH {AUDIT_FP}, t AS (SELECT unnest(tables) AS "table" FROM f) SELECT "table", count(*) AS n FROM t GROUP BY ALL',
    "sql_equivalence": f"WITH {ITEMS} SELECT lower(regexp_replace(trim(regexp_replace(sql_text, '\\s+', ' ', 'g')), ';+$', '')) AS comparable, count(*) AS n, count(DISTINCT sql_text) AS n_texts FROM i WHERE sql_text <> '' GROUP BY 1",
    "unique_patterns": f"WITH {ITEMS} SELECT DISTINCT sql_text FROM i WHERE item_kind = 'STRING'",
    "dataset_statistics": f"WITH {LISTED} SELECT count(*) AS total, count(*) FILTER (n_items > 0) AS with_sql, round(100.0 * count(*) FILTER (n_items > 0) / count(*), 6)::DOUBLE AS coverage, round(avg(n_items), 6) AS mean_items, count(DISTINCT source_file) AS n_files FROM z",
    "sql_type_distribution": f"WITH {LISTED}, t AS (SELECT unnest(sql_types) AS sql_type FROM z) SELECT sql_type, count(*) AS n FROM t GROUP BY ALL",
    "top_files": f"WITH {RECORDS} SELECT source_file, count(*) AS n FROM r GROUP BY ALL ORDER BY n DESC, source_file LIMIT 10",
    "file_statistics": f"WITH {LISTED} SELECT source_file, count(*) AS n, count(*) FILTER (n_items > 0) AS n_with_sql, round(avg(n_items), 6) AS mean_items FROM z GROUP BY ALL",
    "filter_records": f"WITH {LISTED} SELECT record_id, n_items FROM z WHERE len(list_intersect(sql_types, ['UPDATE', 'DELETE'])) > 0 AND n_items >= 2 AND function_name LIKE '%get%' AND source_file LIKE 'part1%.json'",
    "project_records": f"WITH {RECORDS} SELECT record_id, function_name FROM r WHERE contains(function_name, 'proj3')",
    "keyword_tag": f"WITH {RECORDS} SELECT record_id, {JOINED.format(KEYWORDS, '|')} AS keywords FROM r WHERE len({KEYWORDS}) > 0",
    "keyword_frequency": f"WITH {RECORDS}, k AS (SELECT unnest([{', '.join(repr(k) for k in text.GORM_KEYWORDS)}]) AS keyword) SELECT keyword, (SELECT count(*) FROM r WHERE contains(code_value, keyword) OR contains(orm_code, keyword)) AS n FROM k",
    "keyword_partitions": f"WITH {RECORDS}, k AS (SELECT source_file, unnest({KEYWORDS}) AS keyword FROM r) SELECT keyword, source_file, count(*) AS n FROM k GROUP BY ALL",
    "control_flow_detect": f"WITH {RECORDS} SELECT record_id FROM r WHERE regexp_matches(lower(orm_code), 'switch|if|else|case|default')",
    "classify_sql": f"WITH {LINES} SELECT CASE WHEN item_kind = 'PARAM_DEPENDENT' THEN 'PARAM_DEPENDENT' ELSE {CLASS('sql_text')} END AS sql_type, count(*) AS n FROM l GROUP BY 1",
    "sql_type_report": f"WITH {AUDIT} SELECT CASE WHEN sql_text LIKE 'CREATE%' THEN 'DDL' ELSE {CLASS('sql_text')} END AS with_ddl, CASE WHEN sql_text LIKE 'ROLLBACK%' THEN 'TRANSACTION' ELSE {CLASS('sql_text')} END AS with_transactions, count(*) AS n FROM a GROUP BY ALL",
    "complexity_report": f"""WITH {AUDIT}, c AS (SELECT 2 * (event_type = 'click')::INT + len(regexp_replace(sql_text, '[^()]', '', 'g')) + (regexp_matches(sql_text, '\\bWHERE\\b'))::INT + (event_type = 'click')::INT AS s FROM a)
      SELECT CASE WHEN s <= 2 THEN 'SIMPLE' WHEN s <= 8 THEN 'MEDIUM' ELSE 'COMPLEX' END AS complexity, count(*) AS n, sum(s)::BIGINT AS score FROM c GROUP BY 1""",
    "pattern_flags": f"""WITH {AUDIT}, t AS (SELECT unnest(list_filter([CASE WHEN contains(upper(sql_text), 'JOIN') THEN 'HAS_JOIN' END, CASE WHEN contains(upper(sql_text), 'WHERE') THEN 'HAS_WHERE' END, CASE WHEN contains(upper(sql_text), 'GROUP BY') THEN 'HAS_GROUP_BY' END,
      CASE WHEN contains(upper(sql_text), 'ORDER BY') THEN 'HAS_ORDER_BY' END, CASE WHEN contains(upper(sql_text), 'LIMIT') THEN 'HAS_LIMIT' END, CASE WHEN contains(upper(sql_text), 'UNION') THEN 'HAS_UNION' END,
      CASE WHEN regexp_matches(upper(sql_text), '\\bCOUNT\\s*\\(') THEN 'HAS_COUNT' END, CASE WHEN regexp_matches(upper(sql_text), '\\b(SUM|AVG|MIN|MAX)\\s*\\(') THEN 'HAS_AGGREGATION' END, CASE WHEN sql_text LIKE '%?%' OR sql_text LIKE '%:%' THEN 'HAS_PARAMETERS' END], lambda x: x IS NOT NULL)) AS pattern FROM a)
      SELECT pattern, count(*) AS n FROM t GROUP BY ALL""",
    "error_classes": "SELECT ['JSON_PARSE_ERROR', 'JSON_PARSE_ERROR', 'TIMEOUT_ERROR', 'MEMORY_ERROR', 'SQL_ERROR'][1 + event_id % 5] AS error_class, count(*) AS n FROM events GROUP BY 1",
    "naming_styles": f"""WITH {RECORDS}, n AS (SELECT {PURE} AS name FROM r) SELECT CASE WHEN name = 'getUser' THEN 'camelCase' WHEN name LIKE 'GetUser%' THEN 'PascalCase' WHEN name = 'get_user_x' THEN 'snake_case' WHEN name = 'get-user' THEN 'kebab-case' ELSE 'mixed' END AS style,
      count(*) AS n, count(DISTINCT name) AS n_names, round(avg(len(name)), 6) AS mean_length FROM n GROUP BY 1""",
    "name_affixes": f"""WITH {RECORDS}, n AS (SELECT {PURE} AS name FROM r), e AS (SELECT 'prefix' AS kind, name[:3] AS affix FROM n WHERE len(name) > 3 UNION ALL SELECT 'suffix', right(name, 3) FROM n WHERE len(name) > 3)
      SELECT kind, affix, n FROM (SELECT kind, affix, count(*) AS n FROM e GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, affix) <= 10""",
    "sql_complexity_profile": f"""WITH {ITEMS}, s AS (SELECT len(sql_text)::INT AS n, regexp_matches(upper(sql_text), 'JOIN|SUBQUERY|UNION|GROUP BY|HAVING') AS hard FROM i WHERE item_kind = 'STRING' AND sql_text <> '')
      SELECT count(*) FILTER (hard) AS complex, count(*) FILTER (NOT hard) AS simple, round(avg(n), 6) AS mean_length, median(n)::DOUBLE AS median_length, min(n) AS min_length, max(n) AS max_length FROM s""",
    "sql_keyword_frequency": f"WITH {ITEMS}, k AS (SELECT unnest([{', '.join(repr(k) for k in text.ANALYSED_KEYWORDS)}]) AS keyword) SELECT keyword, count(*) AS n FROM k JOIN i ON item_kind = 'STRING' AND contains(upper(sql_text), keyword) GROUP BY ALL",
    "join_patterns": f"WITH {AUDIT}, {ITEMS} SELECT * FROM (SELECT 'SIMPLE JOIN' AS kind, count(*) AS n FROM a WHERE event_type = 'click' UNION ALL SELECT 'LEFT JOIN', count(*) FROM i WHERE sql_text LIKE '%LEFT JOIN%') WHERE n > 0",
    "project_distribution": f"WITH {LISTED} SELECT regexp_extract(function_name, '(proj\\d+)__', 1) AS project, count(*) AS n, count(*) FILTER (n_items > 0) AS n_with_sql, round(avg(n_items), 6) AS mean_items, round(100.0 * count(*) FILTER (n_items > 0) / count(*), 6)::DOUBLE AS coverage FROM z GROUP BY 1",
    "code_patterns": f"""WITH {RECORDS} SELECT round(avg(len(orm_code)), 6) AS mean_length, median(len(orm_code))::DOUBLE AS median_length, count(*) AS with_caller,
      count(*) FILTER (regexp_matches(orm_code, 'gorm|db\\.|Query|Exec|Raw|Model|Table')) AS with_orm, count(*) FILTER (regexp_matches(orm_code, 'error|err|Error|panic|recover')) AS with_error,
      count(*) FILTER (code_value LIKE 'func %') AS go, count(*) FILTER (code_value LIKE 'def %') AS python, count(*) FILTER (code_value LIKE 'import%') AS javascript FROM r""",
    "quality_report": f"""WITH {LISTED} SELECT 100.0::DOUBLE AS function_name, round(100.0 * count(*) FILTER (orm_code <> '') / count(*), 6)::DOUBLE AS orm_code, round(100.0 * count(*) FILTER (n_items > 0) / count(*), 6)::DOUBLE AS statements,
      round(100.0 * count(*) FILTER (len(sql_types) > 0) / count(*), 6)::DOUBLE AS types, 100.0::DOUBLE AS metadata, 100.0::DOUBLE AS source_file, round(100.0 * count(*) FILTER (n_items > 0 AND len(sql_types) > 0) / count(*), 6)::DOUBLE AS alignment, 100.0::DOUBLE AS name_format FROM z""",
    "cjk_rows": f"WITH {ITEMS} SELECT p % 10 = 1 AS cjk, count(*) AS n FROM i GROUP BY 1",
    "pattern_count_agreement": f"WITH {LISTED} SELECT n_items = pattern_cnt AS agrees, count(*) AS n FROM z GROUP BY 1",
    "scenario_rules": "SELECT ['with_first', 'with_take', 'with_last', 'with_count', 'with_find_no_limit', 'plain'][1 + event_id % 6] AS scenario, ['LIMIT 1', 'LIMIT 1', 'ORDER BY pk DESC LIMIT 1', 'COUNT(*)', 'no LIMIT', ''][1 + event_id % 6] AS rule, count(*) AS n FROM events GROUP BY 1, 2",
    "valid_sql_documents": f"SELECT lang, coalesce(trim(text) <> '' AND {VALID.format('text')}, false) AS valid, count(*) AS n FROM documents GROUP BY ALL",
    "clean_sql_items": f"WITH {JUDGED} SELECT record_id, item_pos, CASE WHEN len(sql_text) > 200 THEN left(sql_text, 200) || '...' ELSE sql_text END AS content, reason FROM j WHERE reason IS NOT NULL",
    "clean_records": f"WITH {CLEANED} SELECT record_id, list_state, {JOINED.format('statements', ' ## ')} AS statements FROM cl",
    "cleaning_counters": f"""WITH {JUDGED}, b AS (SELECT record_id, count(*) AS n, count(reason) AS gone, count(*) FILTER (reason = 'cjk') AS cjk, count(*) FILTER (item_kind = 'PARAM_DEPENDENT') AS param FROM j GROUP BY record_id),
      m AS (SELECT record_id, list_state, coalesce(n, 0) AS n, coalesce(gone, 0) AS gone, coalesce(cjk, 0) AS cjk, coalesce(param, 0) AS param FROM r LEFT JOIN b USING (record_id))
      SELECT count(*) AS total_records, count(*) FILTER (gone > 0) AS modified_records, count(*) FILTER (list_state = 'EMPTY' OR n > 0 AND n = gone) AS emptied_records, count(*) FILTER (list_state = 'NO_SQL') AS no_sql_records, sum(n)::BIGINT AS total_items,
        sum(gone)::BIGINT AS removed_items, sum(cjk)::BIGINT AS removed_cjk, sum(n - gone)::BIGINT AS kept_items, sum(param)::BIGINT AS param_dependent_items FROM m""",
    "remove_no_sql": f"WITH {RECORDS}, {LINES} SELECT record_id, list_state FROM r WHERE list_state <> 'NO_SQL' AND record_id NOT IN (SELECT record_id FROM l WHERE item_kind = 'NO_SQL_GENERATE')",
    "completeness_tag": f"""WITH {TAGGED}, y AS (SELECT *, list_state <> 'NO_SQL' AND reply LIKE '否%' AS bad FROM x) SELECT record_id, NOT bad AS is_complete, CASE WHEN bad THEN substr(reply, 3) ELSE '' END AS reason, CASE WHEN bad THEN 'LACK_INFO' ELSE list_state END AS list_state FROM y""",
    "correctness_tag": f"""WITH {TAGGED} SELECT record_id, true AS is_correct, '' AS reason FROM x WHERE NOT (list_state NOT IN ('NO_SQL', 'LACK_INFO') AND reply LIKE '否%' AND NOT regexp_matches(reply, '事务|表名'))
      UNION ALL SELECT record_id, false, substr(reply, 3) FROM x WHERE list_state NOT IN ('NO_SQL', 'LACK_INFO') AND reply LIKE '否%' AND NOT regexp_matches(reply, '事务|表名')""",
    "reanalysis_selection": f"WITH {TAGGED} SELECT record_id, CASE WHEN orm_code = '' THEN code_value ELSE orm_code END AS code, raw IS NOT NULL AND record_id % 9 < 4 AS has_new_sql FROM x WHERE list_state = 'NO_SQL'",
    "reanalysis_summary": f"WITH {TAGGED} SELECT count(*) AS total, count(*) FILTER (raw IS NOT NULL AND record_id % 9 < 4) AS generated, count(*) FILTER (NOT (raw IS NOT NULL AND record_id % 9 < 4)) AS kept FROM x WHERE list_state = 'NO_SQL'",
    "align_schema": f"SELECT o_orderkey AS record_id, ({src.FUNCTION_NAME}) AS function_name, CASE WHEN o_orderkey % 2 = 0 THEN ({src.ORM_CODE}) ELSE '' END AS orm_code, '' AS caller, CASE WHEN o_orderkey % 3 = 0 THEN 'LIST' ELSE 'OTHER' END AS list_state, 0 AS sql_pattern_cnt, 0 AS n_meta FROM orders",
    "ingest_items": """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders) SELECT k AS record_id, 0 AS item_pos, 0 AS sub_pos, 'STRING' AS item_kind, 0 AS variant_pos, NULL::VARCHAR AS scenario, 0 AS sql_pos, 'SELECT ' || c || ';' AS sql_text FROM o WHERE k % 4 = 0
      UNION ALL SELECT k, 1, 0, 'STRING', 0, NULL, 0, 'A' FROM o WHERE k % 4 = 0 UNION ALL SELECT k, 1, 1, 'STRING', 0, NULL, 0, 'B' FROM o WHERE k % 4 = 0
      UNION ALL SELECT k, 0, 0, 'PARAM_DEPENDENT', 0, 's', 0, 'U' || c FROM o WHERE k % 4 = 1 UNION ALL SELECT k, 0, 0, 'PARAM_DEPENDENT', 1, 't', 0, 'V' FROM o WHERE k % 4 = 1 UNION ALL SELECT k, 0, 0, 'PARAM_DEPENDENT', 1, 't', 1, 'W' FROM o WHERE k % 4 = 1""",
    "export_csv": f"WITH {LISTED}, e AS (SELECT *, repeat(orm_code, 5) AS code FROM z) SELECT function_name, CASE WHEN len(code) > 200 THEN left(code, 200) || '...' ELSE code END AS orm_code, caller, array_to_string(sql_types, '|') AS sql_types, n_items AS n_statements, source_file FROM e",
    "caller_fingerprints": f"WITH {SETS} SELECT orm_code, caller, {JOINED.format('fps', ',')} AS fps, n_sql, first_seen, n_fp FROM c",
    "reference_callers": f"WITH {SETS} SELECT orm_code, caller, n_fp, n_sql FROM ref",
    "caller_diff": f"""WITH {SETS} SELECT orm_code, caller, reference, {JOINED.format('common', ',')} AS common, {JOINED.format('missing', ',')} AS missing, {JOINED.format('extra', ',')} AS extra, len(extra) = 0 AS is_subset, len(missing) = 0 AS is_superset,
      round(len(common) / (len(common) + len(missing) + len(extra))::DOUBLE, 6) AS jaccard FROM d""",
    "diff_candidates": f"WITH {CANDIDATES} SELECT orm_code, type, count(*) AS n, sum(len(fps))::BIGINT AS n_fps FROM q GROUP BY ALL",
    "candidate_queue": f"""WITH {CANDIDATES}, n AS (SELECT *, row_number() OVER (PARTITION BY orm_code ORDER BY place, first_seen, caller)::INT AS validation_no FROM q)
      SELECT orm_code, caller, type, validation_no, CASE type WHEN 'missing' THEN 'medium' ELSE 'high' END AS priority FROM n QUALIFY row_number() OVER (PARTITION BY type ORDER BY orm_code, validation_no) <= 50""",
    "mark_redundant": f"""WITH {CANDIDATES}, b AS (SELECT DISTINCT orm_code, caller, unnest(fps) AS fp FROM q WHERE type = 'redundant') SELECT record_id, count(*) AS n, count(b.fp) AS n_redundant FROM s LEFT JOIN b ON s.orm_code = b.orm_code AND s.caller = b.caller AND s.fp = b.fp GROUP BY record_id""",
    "orm_summary": f"WITH {CANDIDATES} SELECT type, count(*) AS n, count(DISTINCT orm_code) AS n_methods, round(count(*) / count(DISTINCT orm_code)::DOUBLE, 6) AS per_method FROM q GROUP BY type",
    "fix_maps": f"WITH {DECISIONS} SELECT *, 'remove' AS action FROM gone UNION ALL SELECT *, 'add' FROM more",
    "apply_fixes": f"""WITH {DECISIONS}, {ITEMS}, t AS (SELECT orm_code, caller FROM gone UNION SELECT orm_code, caller FROM more), own AS (SELECT record_id, r.orm_code, r.caller, t.caller IS NOT NULL AS touched FROM r LEFT JOIN t ON r.orm_code = t.orm_code AND r.caller = t.caller),
      b AS (SELECT own.*, item_pos, variant_pos, CASE WHEN NOT touched AND record_id % 2 = 0 THEN sql_text || '{text.REDUNDANT}' ELSE sql_text END AS x FROM i JOIN own USING (record_id)),
      kept AS (SELECT record_id, touched, item_pos, variant_pos, x FROM b WHERE NOT touched OR trim(x) <> '' AND NOT EXISTS (FROM gone WHERE gone.orm_code = b.orm_code AND gone.caller = b.caller AND gone.sql_text = b.x)
        UNION ALL SELECT record_id, touched, 2147483647, 0, sql_text FROM own JOIN more ON own.orm_code = more.orm_code AND own.caller = more.caller),
      g AS (SELECT record_id, list(x ORDER BY item_pos, variant_pos, x) AS l FROM kept GROUP BY record_id)
      SELECT record_id, touched, coalesce({JOINED.format('l', ' ## ')}, '') AS statements FROM own LEFT JOIN g USING (record_id) WHERE NOT touched OR l IS NOT NULL""",
    "keyword_split": f"WITH {RECORDS}, k AS (SELECT *, function_name || ':' || left(orm_code, 100) || ':' || caller AS key FROM r) SELECT record_id FROM k WHERE key NOT IN (SELECT key FROM k WHERE len({KEYWORDS}) > 0)",
    "merge_back": f"""WITH {RECORDS}, last AS (SELECT event_id % 900 AS key, max(event_id) AS e FROM events GROUP BY 1) SELECT record_id, record_id % 700 AS key, CASE WHEN e % 2 = 0 THEN 'new' || e ELSE caller END AS caller, e IS NOT NULL AS processed FROM r LEFT JOIN last ON record_id % 700 = last.key""",
    "concat_final": "SELECT o_orderkey AS record_id, 'keyword' AS part FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'rest' FROM orders WHERE o_orderkey % 3 = 0",
    "dataset_compare": f"""WITH {ITEM_FP}, a AS (SELECT record_id, list(DISTINCT fp) AS a FROM fi GROUP BY 1), b AS (SELECT record_id, list(DISTINCT CASE WHEN item_pos = 3 THEN 'added' ELSE fp END) AS b FROM fi WHERE (record_id + item_pos) % 4 <> 0 AND record_id % 11 <> 0 GROUP BY 1),
      o AS (SELECT record_id, b IS NOT NULL AS matched, a, coalesce(b, []) AS b FROM a LEFT JOIN b USING (record_id)),
      m AS (SELECT *, list_sort(list_intersect(a, b)) AS common, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS missing, list_sort(list_filter(b, lambda x: NOT list_contains(a, x))) AS extra FROM o)
      SELECT record_id, matched, {JOINED.format('common', ',')} AS common, {JOINED.format('missing', ',')} AS missing, {JOINED.format('extra', ',')} AS extra, len(a)::INT AS n_left, len(b)::INT AS n_right, len(common)::INT AS n_common, len(missing)::INT AS n_missing, len(extra)::INT AS n_extra FROM m""",
    "condition_labels": f"""WITH {RECORDS}, k AS (SELECT DISTINCT function_name, orm_code, caller FROM r WHERE record_id % 6 = 1) SELECT record_id, concat_ws('|', CASE WHEN EXISTS (FROM k WHERE k.function_name = r.function_name AND k.orm_code = r.orm_code AND k.caller = r.caller) THEN 'if-else' END, CASE WHEN len({KEYWORDS}) > 0 THEN 'keyword' END) AS condition FROM r""",
    "condition_distribution": f"""WITH {RECORDS}, k AS (SELECT DISTINCT function_name, orm_code, caller FROM r WHERE record_id % 6 = 1), c AS (SELECT concat_ws('|', CASE WHEN EXISTS (FROM k WHERE k.function_name = r.function_name AND k.orm_code = r.orm_code AND k.caller = r.caller) THEN 'if-else' END, CASE WHEN len({KEYWORDS}) > 0 THEN 'keyword' END) AS condition FROM r)
      SELECT condition, count(*) AS n FROM c GROUP BY ALL""",
    "clean_labels": f"""WITH {RECORDS}, k AS (SELECT DISTINCT function_name, orm_code, caller FROM r WHERE record_id % 6 = 1), c AS (SELECT record_id, EXISTS (FROM k WHERE k.function_name = r.function_name AND k.orm_code = r.orm_code AND k.caller = r.caller) AS i, len({KEYWORDS}) > 0 AS w FROM r)
      SELECT record_id, concat_ws('|', CASE WHEN i AND record_id % 2 = 1 THEN 'if-else' END, CASE WHEN w THEN 'keyword' END) AS condition, i AND record_id % 2 = 0 AS changed FROM c""",
    "field_set_difference": "SELECT * FROM (VALUES ('custkey', 'left'), ('mktsegment', 'left'), ('suppkey', 'right'), ('name', 'both'), ('nationkey', 'both'), ('acctbal', 'both')) AS t(field, side)",
    "pack_callers": """WITH o AS (SELECT o_orderkey AS pack, CASE o_orderkey % 3 WHEN 0 THEN 'mutual_exclusive_conditions' ELSE 'plain' END AS scenario, o_custkey % 3 AS k FROM orders)
      SELECT pack, scenario, '' AS caller FROM o WHERE scenario = 'plain' UNION ALL SELECT pack, scenario, 'c' || i FROM o JOIN (SELECT unnest([1, 2]) AS i) ON i <= k""",
    "parse_responses": f"WITH {REPLIES} SELECT reply_id, {JOINED.format(PARSED, ' ## ')} AS statements FROM p",
    "statements_by_verb": f"""WITH {REPLIES} SELECT reply_id, CASE reply_id % 9 WHEN 0 THEN 'SELECT a FROM t WHERE id = ' || user_id || '; ## DELETE FROM t;' WHEN 1 THEN 'UPDATE s SET a = ' || user_id || ';' WHEN 2 THEN 'INSERT INTO k VALUES (' || (user_id % 10) || ');'
      WHEN 3 THEN 'SELECT x FROM y' || (user_id % 5) || ';' WHEN 8 THEN 'SELECT q FROM r WHERE z = ' || (user_id % 4) || ';' ELSE '' END AS statements FROM p""",
    "harvest_sql": f"WITH {REPLIES} SELECT reply_id, CASE WHEN reply_id % 9 = 8 THEN 'SELECT q FROM r WHERE z = ' || (user_id % 4) ELSE '' END AS statements FROM p",
    "syntax_check": f"WITH {AUDIT} SELECT regexp_matches(sql_text, '^(SELECT|SHOW|EXPLAIN|SET|ANALYZE|CREATE|ALTER|DROP|INSERT|UPDATE|DELETE|DESCRIBE|USE)') AS ok, count(*) AS n FROM a GROUP BY 1",
    "validate_output_format": f"""WITH {REPLIES}, q AS (SELECT reply_id, reply_id % 9 AS m FROM p)
      SELECT reply_id, m = 0 AS json, m IN (4, 6, 7) AS boolean, m = 0 AS list, m IN (0, 6, 7, 8) AS completeness, m = 0 AS keyword, m = 0 AS regeneration, m = 0 AS sql_generation, m = 4 AS precheck FROM q""",
    "keyword_responses": f"WITH {REPLIES} SELECT reply_id, CASE WHEN reply_id % 9 = 8 THEN 'Preload|save' ELSE '' END AS keywords FROM p",
    "first_valid_attempt": f"WITH {REPLIES} SELECT (reply_id // 3)::BIGINT AS sample, min(reply_id % 3) FILTER (reply_id % 9 = 0) AS attempt FROM p GROUP BY 1",
    "redundancy_decisions": """WITH s AS (SELECT l_orderkey AS candidate, ['redundant', 'new', 'missing'][1 + l_orderkey % 3] AS type, avg((l_partkey % 3 < 2)::INT) AS share FROM lineitem GROUP BY ALL)
      SELECT candidate, type, round(share, 6) AS share, CASE WHEN share < 0.6 THEN 'keep' WHEN type = 'missing' THEN 'add' ELSE 'remove' END AS decision FROM s""",
    "validation_counters": """WITH s AS (SELECT l_orderkey AS candidate, ['redundant', 'new', 'missing'][1 + l_orderkey % 3] AS type, avg((l_partkey % 3 < 2)::INT) AS share FROM lineitem GROUP BY ALL)
      SELECT type, CASE WHEN share < 0.6 THEN 'keep' WHEN type = 'missing' THEN 'add' ELSE 'remove' END AS decision, count(*) AS n FROM s GROUP BY ALL""",
    "control_flow_totals": f"""WITH {TAGGED}, y AS (SELECT *, CASE WHEN reply = '' THEN 'error' WHEN reply LIKE '否%' THEN 'incorrect' ELSE 'correct' END AS v FROM x WHERE regexp_matches(lower(orm_code), 'switch|if|else|case|default'))
      SELECT count(*) AS detected, count(*) FILTER (v = 'correct') AS correct, count(*) FILTER (v = 'incorrect') AS incorrect, count(*) FILTER (v = 'error') AS error, coalesce(round(count(*) FILTER (v = 'correct') / nullif(count(*), 0)::DOUBLE, 6), 0)::DOUBLE AS rate FROM y""",
    "eval_statistics": f"WITH {EVALUATED} SELECT count(*) AS samples, count(*) FILTER (valid >= 1) AS with_valid, count(*) FILTER (matched >= 1) AS with_match, sum(n)::BIGINT AS statements, sum(valid)::BIGINT AS valid, sum(matched)::BIGINT AS matched, round(coalesce(sum(matched) / nullif(sum(valid), 0), 0), 6)::DOUBLE AS match_rate FROM ev",
    "quality_scores": f"WITH {EVALUATED} SELECT score, CASE WHEN score >= 4 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS band, count(*) AS n FROM qs GROUP BY ALL",
    "examples_per_class": f"WITH {EVALUATED}, k AS (SELECT *, CASE WHEN score >= 5 THEN 'excellent' WHEN score >= 3 THEN 'good' ELSE 'poor' END AS kind FROM qs), o AS (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY user_id)::INT AS k, user_id, score FROM k) SELECT * FROM o WHERE k <= 3",
    "coverage_analysis": f"WITH {AUDIT_FP} SELECT fp, count(*) AS n FROM f WHERE stmt_id % 2 = 1 AND fp IN (SELECT fp FROM f WHERE stmt_id % 2 = 0) GROUP BY fp ORDER BY n DESC, fp LIMIT 20",
    "viewer_summary": f"""WITH {LISTED}, m AS (SELECT z.*, x.variants FROM z LEFT JOIN (SELECT record_id, count(*) AS variants FROM i WHERE item_kind = 'PARAM_DEPENDENT' GROUP BY 1) x USING (record_id))
      SELECT coalesce(source_file, 'ALL') AS source_file, count(*) AS n, count(*) FILTER (n_items > 0) AS with_sql, count(*) FILTER (n_items = 0) AS without_sql, count(variants) AS param_dependent, count(*) FILTER (regexp_matches(orm_code, 'switch|if')) AS control_flow, coalesce(sum(variants), 0)::BIGINT AS variants
      FROM m GROUP BY GROUPING SETS ((source_file), ())""",
    "reward_v2": f"WITH {REWARDS} SELECT doc_id, {V2} AS reward FROM w",
    "reward_five_dim": f"WITH {REWARDS} SELECT doc_id, {HALF_EVEN("greatest((0.25::DOUBLE * validity + 0.20::DOUBLE * consistency + 0.15::DOUBLE * coalesce(keyword, 0) + 0.20::DOUBLE * branch) / (CASE WHEN keyword IS NULL THEN 0.65 ELSE 1 END)::DOUBLE - 0.2::DOUBLE * severity, 0)", 2)} AS reward FROM w",
    "composite_reward": f"WITH {REWARDS} SELECT doc_id, {HALF_EVEN("0.30::DOUBLE * validity + 0.30::DOUBLE * consistency + 0.40::DOUBLE * (" + HALF_EVEN("greatest(least(0.6::DOUBLE * branch + 0.4::DOUBLE * severity - 0.1::DOUBLE - 0.3::DOUBLE * (doc_id % 2), 1), 0)", 2) + ")", 2)} AS reward FROM w",
    "branch_exclusivity": f"WITH {REWARDS}, y AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE keyword END AS s, branch FROM w) SELECT doc_id, round(least(coalesce(nullif(s, 0), nullif(branch, 0), 1.5), 1), 6)::DOUBLE AS score FROM y",
    "reward_bands": f"WITH {REWARDS}, y AS (SELECT {V2} AS v FROM w) SELECT CASE WHEN v >= 0.8 THEN '0.8-1.0' WHEN v >= 0.6 THEN '0.6-0.8' WHEN v >= 0.4 THEN '0.4-0.6' ELSE '0.0-0.4' END AS band, count(*) AS n, round(avg(v), 3) AS mean FROM y GROUP BY 1",
    "validity_score": f"WITH {AUDIT_FP} SELECT user_id, {HALF_EVEN("avg((fp <> 'invalid_sql')::INT)", 2)} AS validity FROM f GROUP BY user_id",
    "consistency_score": f"WITH {AUDIT_FP}, x AS (SELECT stmt_id, list_distinct(list_transform(tables, lambda v: lower(v))) AS t, list_distinct(list_transform(columns, lambda v: lower(v))) AS c FROM f WHERE len(tables) > 0) SELECT x.stmt_id, {HALF_EVEN(f"0.6::DOUBLE * ({JACCARD('x.t', 'y.t')}) + 0.4::DOUBLE * ({JACCARD('x.c', 'y.c')})", 2)} AS score FROM x JOIN x AS y ON x.stmt_id = y.stmt_id + 1",
    "stratified_quota": f"WITH {RECORDS} SELECT source_file, count(*) AS size, greatest(1, floor(count(*) * 1000 / (SELECT count(*) FROM r)))::BIGINT AS quota FROM r GROUP BY source_file",
    "sample_sizes": "SELECT * FROM (VALUES ('sample', 123::BIGINT), ('stratified', 500::BIGINT)) UNION ALL SELECT 'all', count(*) FROM orders",
    "guaranteed_sample": "SELECT 1000::BIGINT AS n, count(*) AS n_privileged FROM orders WHERE o_orderkey % 100 = 0",
    "train_val_split": "SELECT 'val' AS split, floor(count(*) * 0.1)::BIGINT AS n FROM orders UNION ALL SELECT 'train', count(*) - floor(count(*) * 0.1)::BIGINT FROM orders",
    "complexity_rotation": "SELECT ['simple', 'medium', 'complex'][1 + event_id % 3] AS complexity, count(*) AS n FROM events GROUP BY 1",
    "sft_samples": f"""WITH {CLEANED} SELECT record_id, 'Code: ' || CASE WHEN orm_code = '' THEN code_value ELSE orm_code END || chr(10) || 'Caller: ' || caller AS instruction, to_json(statements)::VARCHAR AS output, function_name FROM cl JOIN r USING (record_id) WHERE cl.list_state = 'LIST'""",
    "rl_samples": f"""WITH {RECORDS}, {ITEM_FP}, t AS (SELECT record_id, unnest(CASE k % 6 WHEN 0 THEN ['part' || (k % 4)] WHEN 1 THEN ['part' || (k % 4)] WHEN 2 THEN CASE WHEN v = 1 THEN [] ELSE ['log' || (k % 3)] END WHEN 3 THEN ['line' || (k % 4)] WHEN 4 THEN ['a' || (k % 5), 'b'] ELSE ['c'] END) AS t FROM fi WHERE p % 10 NOT IN (1, 2)),
      c AS (SELECT record_id, unnest(CASE k % 6 WHEN 0 THEN ['id'] WHEN 1 THEN ['id', 'qty'] WHEN 2 THEN CASE WHEN v = 1 THEN [] ELSE ['a', 'b'] END WHEN 3 THEN ['id'] WHEN 4 THEN ['aid', 'id', 'x'] ELSE [] END) AS c FROM fi WHERE p % 10 NOT IN (1, 2)),
      tt AS (SELECT record_id, list_sort(list(DISTINCT t)) AS tables FROM t GROUP BY 1), cc AS (SELECT record_id, list_sort(list(DISTINCT c)) AS columns FROM c GROUP BY 1)
      SELECT record_id, 'orm_to_sql' AS data_source, array_to_string(tables, ',') AS tables, coalesce(array_to_string(columns, ','), '') AS columns FROM r JOIN tt USING (record_id) LEFT JOIN cc USING (record_id) WHERE orm_code <> '' AND list_state <> 'LACK_INFO'""",
    "next_version": "SELECT (max(event_id % 37) + 1)::INT AS version FROM events",
    "workflow_stats": """WITH s AS (SELECT ['load', 'clean', 'tag', 'export'][1 + o_orderkey % 4] AS step_type, o_custkey AS a, o_custkey // 2 AS b, o_orderkey AS k FROM orders)
      SELECT step_type, count(*) AS n, sum(a)::BIGINT AS n_in, sum(b)::BIGINT AS n_out, arg_max(b, k) AS last_out, round(sum(b) / sum(a), 6)::DOUBLE AS retention FROM s GROUP BY 1""",
    "generation_stats": f"WITH {REPLIES}, t AS (SELECT reply, CASE WHEN trim(reply) = '' THEN 0 ELSE len(regexp_split_to_array(trim(reply), '\\s+')) END AS k FROM p) SELECT count(*) AS requests, count(*) FILTER (reply <> '') AS succeeded, sum(k)::BIGINT AS tokens, round(avg(k), 6) AS mean_tokens FROM t",
}
SQL["sample_sizes"] = SQL["sample_sizes"].replace("SELECT * FROM (VALUES ('sample', 123::BIGINT), ('stratified', 500::BIGINT))", "SELECT * FROM (VALUES ('sample', 123::BIGINT), ('stratified', 500::BIGINT)) AS t(kind, n)")
