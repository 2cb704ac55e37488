"""Results of an evaluation run as raw JSON rows, derived from ``orders``, and a catalog of statements, derived from ``supplier``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import table
from .replies import nth

#: Statements: two of the catalog, one of a table it has with another type, one of a table it lacks, excluded ones, a wrapper, a blank, and two that share tables with it.
S = (
    "SELECT a FROM t1x WHERE k = 5", "DELETE FROM d WHERE z = 1", "UPDATE u SET v = 1 WHERE w = 2", "INSERT INTO nowhere (a) VALUES (1)", "SHOW TABLES",
    "SELECT NOW()", "BEGIN; UPDATE x SET a = 1; COMMIT", " ", "SELECT b FROM d", "SELECT other FROM u WHERE o = 1",
)
LIST = "sql_statement_list"


def group(*variants) -> dict:
    return {"type": "param_dependent", "variants": [{"scenario": "s", "sql": v} if v is not None else {"scenario": "s"} for v in variants]}


ROWS = [
    {LIST: [S[0], S[4], S[6]], "sql_pattern_cnt": 3},
    {LIST: S[1], "caller_results": [{"caller": "c", LIST: [S[2], group(S[4], S[0])]}], "sql_pattern_cnt": 2},
    {LIST: [S[3], group(["", S[9]], S[6]), {"type": "param_dependent", "variants": []}]},
    {"caller_results": [{LIST: []}, {LIST: S[7]}], LIST: [S[5], S[8]], "sql_pattern_cnt": "4"},
    {LIST: [group(S[4], S[6], None)], "sql_pattern_cnt": None},
    {LIST: "", "sql_pattern_cnt": "x"},
]
#: Of each kind of row: its units as (place, unit, first statement), and the statements left out by reason, written out by hand.
UNITS = [
    [((-1, 0), "matched", S[0]), ((-1, 1), "excluded", S[4]), ((-1, 2), "wrapper", S[6])],
    [((0, 0), "unmatched", S[2]), ((0, 1), "matched", S[4]), ((-1, 0), "matched", S[1])],
    [((-1, 0), "unmatched", S[3]), ((-1, 1), "unmatched", S[9])],
    [((-1, 0), "excluded", S[5]), ((-1, 1), "unmatched", S[8])],
    [((-1, 0), "excluded", S[4])],
    [],
]
LEFT_OUT = [[(S[4], "show_command"), (S[6], "transaction_wrapper")], [(S[4], "show_command")], [(S[6], "transaction_wrapper")], [(S[5], "system_function")], [(S[4], "show_command"), (S[6], "transaction_wrapper")], []]
OFFICIAL = [3, 2, 3, 4, 0, 0]
KNOWN = ["SELECT a FROM t1x WHERE k = 9", "DELETE FROM d WHERE z = 3", "SELECT q FROM u", "SHOW DATABASES", "SELECT x FROM unseen"]
#: The catalog's fingerprints, by hand.
KNOWN_FPS = ["md5('type_1.tables_t1x.predicates_k')", "md5('type_4.tables_d.predicates_z')", "md5('type_1.tables_u.predicates_')", "'show_command'", "md5('type_1.tables_unseen.predicates_')"]


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, row variant): a row an order; a customer's rows share the sample."""
    body = F.expr(nth([json.dumps(r) for r in ROWS], "o_orderkey"))
    text = F.concat(F.lit('{"sample_id": "s'), "o_custkey", F.lit('", '), F.expr("substring(body, 2)"))
    return table(spark, sf_dir, "orders").withColumn("body", body).select(F.col("o_orderkey").alias("pos"), F.parse_json(text).alias("row"))


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seen, sql_text): the catalog's statements in the order seen."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seen"), F.expr(nth(KNOWN, "s_suppkey")).alias("sql_text"))
