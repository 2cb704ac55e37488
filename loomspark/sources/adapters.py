"""Record-shaped inputs derived from the star-schema tables.

The expressions are plain SQL that Spark and DuckDB read alike; ``plans.oracle``
uses the same ones, so that both sides start from equal inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = "chr(39)"

#: Statement text of an event.
AUDIT = f"""CASE event_type
 WHEN 'view' THEN 'SELECT id, name FROM User' || (user_id % 5) || CASE event_id % 8 WHEN 2 THEN '_old' WHEN 3 THEN '_new' ELSE '_items' END || ' WHERE user_id = ' || user_id || ' AND value > ' || cast(floor(value) AS bigint) || ' LIMIT ' || (event_id % 10 + 1)
 WHEN 'click' THEN 'SELECT o.id,  COUNT(*) FROM orders o JOIN Users' || (user_id % 3) || ' u ON o.uid = u.id WHERE o.status = ' || {Q} || 'S' || (event_id % 4) || {Q} || ' AND (u.age >= 18 OR u.vip IN (1, 2)) GROUP BY o.id HAVING COUNT(*) > 1 ORDER BY o.id'
 WHEN 'purchase' THEN 'UPDATE Stock' || (user_id % 4) || ' SET qty = ' || (event_id % 50) || ', note = "n" WHERE item_id = ' || event_id || ' AND shop_id IN (1, 2, ' || (user_id % 7) || ')'
 WHEN 'signup' THEN 'INSERT INTO Accounts' || (user_id % 3) || ' (id, name) VALUES (' || event_id || ', ' || {Q} || 'u' || user_id || {Q} || ')'
 ELSE CASE event_id % 10 WHEN 0 THEN 'ROLLBACK' WHEN 1 THEN 'SHOW TABLES' WHEN 2 THEN 'SET NAMES utf8' WHEN 3 THEN 'CREATE TABLE x (id INT)' WHEN 4 THEN '查询用户'
   WHEN 5 THEN 'please look at the log' WHEN 6 THEN 'SELECT NOW()' WHEN 7 THEN 'DELETE FROM Sessions WHERE token LIKE ' || {Q} || 'a%' || {Q} || ' -- purge' WHEN 8 THEN 'BEGIN; COMMIT' ELSE 'SELECT FROM WHERE' END END"""

FUNCTION_NAME = """'/data/ws/go/src/app/proj' || (o_custkey % 7) || '__svc' || (o_orderkey % 3) || '/f' || (o_orderkey % 11) || '.go:' || (o_orderkey % 90 + 1) || ':' || (o_orderkey % 90 + 20) || ':' ||
 CASE o_orderkey % 5 WHEN 0 THEN 'getUser' WHEN 1 THEN 'GetUser' || (o_orderkey % 13) WHEN 2 THEN 'get_user_x' WHEN 3 THEN 'get-user' ELSE 'get_user-z' END"""
GROUP = "cast(floor(o_orderkey / 4) AS bigint) % 500"
ORM_CODE = f"""CASE WHEN {GROUP} % 6 = 5 THEN '' ELSE 'func (d *Dao) M' || ({GROUP}) || '(db *gorm.DB) error {{ ' || CASE {GROUP} % 6
 WHEN 0 THEN 'return db.Preload("x").Find(&u).Error' WHEN 1 THEN 'if err != nil {{ return err }}; db.Model(u).save(u)' WHEN 2 THEN 'switch t {{ default: db.Raw(q) }}'
 WHEN 3 THEN 'db.Transaction(f).Pluck(g)' ELSE 'verify(u); db.Table(t).Exec(q)' END || ' }}' END"""
CODE_VALUE = "CASE o_custkey % 4 WHEN 0 THEN 'type U struct { Locking bool }' WHEN 1 THEN 'def helper(x): pass' WHEN 2 THEN 'import x; function f() { }' ELSE 'func plain() { }' END"
STATE = "CASE o_orderkey % 9 WHEN 0 THEN 'NO_SQL' WHEN 1 THEN 'EMPTY' WHEN 2 THEN 'LACK_INFO' ELSE 'LIST' END"

#: name -> expression over ``orders``.
RECORD = {
    "record_id": "o_orderkey",
    "function_name": FUNCTION_NAME,
    "orm_code": ORM_CODE,
    "caller": "'caller' || (o_orderkey % 4)",
    "code_value": CODE_VALUE,
    "source_file": "'part' || (o_orderkey % 17) || '.json'",
    "pattern_cnt": "cast(o_custkey % 5 AS int)",
    "list_state": STATE,
}
KIND = "CASE l_partkey % 10 WHEN 0 THEN 'PARAM_DEPENDENT' WHEN 3 THEN 'NO_SQL_GENERATE' ELSE 'STRING' END"
STATEMENT = f"""CASE WHEN l_partkey % 10 = 1 THEN '查询订单 SELECT' WHEN l_partkey % 10 = 2 THEN 'nothing to do here' WHEN l_partkey % 10 = 3 THEN '' ELSE CASE l_suppkey % 6
 WHEN 0 THEN 'SELECT * FROM part' || (l_suppkey % 4) || ' WHERE id = ' || l_partkey WHEN 1 THEN 'UPDATE part' || (l_suppkey % 4) || ' SET qty = 1 WHERE id = 5'
 WHEN 2 THEN 'INSERT INTO log' || (l_suppkey % 3) || ' (a, b) VALUES (1, 2);' WHEN 3 THEN 'DELETE FROM line' || (l_suppkey % 4) || ' WHERE id IN (1, 2)'
 WHEN 4 THEN 'SELECT a.id FROM a' || (l_suppkey % 5) || ' a LEFT JOIN b ON a.id = b.aid WHERE b.x LIKE ' || {Q} || 'q%' || {Q} ELSE 'SELECT COUNT(*) FROM c GROUP BY d HAVING COUNT(*) > 2' END END"""
ITEM = {
    "record_id": "l_orderkey",
    "item_pos": "cast(l_linenumber AS int)",
    "item_kind": KIND,
    "scenario": f"CASE WHEN {KIND} = 'PARAM_DEPENDENT' THEN 'case ' || (l_suppkey % 3) END",
    "sql_text": STATEMENT,
}
#: Orders with a statement list.
LISTED = "l_orderkey % 9 > 2"

#: A model's reply as raw text, over ``events``.
REPLY = f"""CASE event_id % 9
 WHEN 0 THEN '["SELECT a FROM t WHERE id = ' || user_id || ';", "DELETE FROM t;"]'
 WHEN 1 THEN 'Here it is:' || chr(10) || '```json' || chr(10) || '["UPDATE s SET a = ' || user_id || ';"]' || chr(10) || '```' || chr(10) || 'Done.'
 WHEN 2 THEN 'The answer is ["INSERT INTO k VALUES (' || (user_id % 10) || ');"] as asked'
 WHEN 3 THEN 'SELECT x FROM y' || (user_id % 5) || ';' || chr(10) || 'and that is all'
 WHEN 4 THEN 'no' WHEN 5 THEN '' WHEN 6 THEN '否，缺少表' || (user_id % 3)
 WHEN 7 THEN '是' ELSE 'Use `SELECT q FROM r WHERE z = ' || (user_id % 4) || ';` and [Preload, save]' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stmt_id, sql_text, user_id)."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("stmt_id"), F.expr(AUDIT).alias("sql_text"), "user_id")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*[F.expr(e).alias(n) for n, e in RECORD.items()])


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per statement text; param_dependent items have two variants."""
    lines = table(spark, sf_dir, "lineitem").where(LISTED).select(*[F.expr(e).alias(n) for n, e in ITEM.items()])
    variants = F.when(F.col("item_kind") == "PARAM_DEPENDENT", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return lines.withColumn("variant_pos", F.explode(variants)).withColumn("sql_text", F.when(F.col("variant_pos") == 1, F.concat("sql_text", F.lit(" LIMIT 1"))).otherwise(F.col("sql_text")))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reply_id, user_id, reply)."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("reply_id"), "user_id", F.expr(REPLY).alias("reply"))
