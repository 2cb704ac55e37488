"""Statement lists in their raw form, derived from ``orders``, with what fixes and other operators make of them, written out by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import table
from .replies import nth

V = '{"type":"param_dependent","variants":['
ADDED = '{"scenario":"补充的必要SQL","sql":"NEW %d"}'
LISTS = [
    '"<NO SQL GENERATE>"',
    '"SELECT a <REDUNDANT SQL>"',
    '"DELETE b"',
    '["SELECT a","DELETE b <REDUNDANT SQL>","",["DELETE b"],' + V + '{"scenario":"s","sql":"DELETE b"},{"scenario":"t","sql":["DELETE b","X "]},{"scenario":"u"}]}]',
    '["DELETE b"]',
    V + '{"scenario":"s","sql":"DELETE b"}]}',
    '{"sql":"DELETE b","description":"d"}',
    '[5,{"note":1},{"sql":["DELETE b"]}]',
]
LEFT = V + '{"scenario":"t","sql":["X"]},{"scenario":"u"}]}'
#: After a removal of DELETE b; after the addition of NEW 1; after both, of NEW 1 and NEW 2. None: the record goes.
FIXED = {
    1: [None, '"SELECT a"', None, f'["SELECT a",{LEFT}]', None, None, LISTS[6], "[5]"],
    2: [
        '"NEW 1"', '["SELECT a","NEW 1"]', '["DELETE b","NEW 1"]', '["SELECT a","DELETE b",["DELETE b"],' + V + '{"scenario":"s","sql":"DELETE b"},{"scenario":"t","sql":["DELETE b","X"]},{"scenario":"u"}]},"NEW 1"]',
        '["DELETE b","NEW 1"]', V + '{"scenario":"s","sql":"DELETE b"},' + ADDED % 1 + "]}", LISTS[6], '[5,{"sql":["DELETE b"]},"NEW 1"]',
    ],
    3: ['["NEW 1","NEW 2"]', '["SELECT a","NEW 1","NEW 2"]', '["NEW 1","NEW 2"]', f'["SELECT a",{LEFT},"NEW 1","NEW 2"]', '["NEW 1","NEW 2"]', V + ADDED % 1 + "," + ADDED % 2 + "]}", LISTS[6], '[5,"NEW 1","NEW 2"]'],
}
#: The key of a list is the order's number modulo 32: its kind, and which fixes its method and caller have.
KIND, FIX = "o_orderkey % 8", "(o_orderkey // 8) % 4"
SENTINELS = [('"<NO SQL GENERATE>"', (1, 1, 1)), ('["<NO SQL GENERATE>"]', (0, 1, 1)), ('[{"type":"NO_SQL_GENERATE","variants":[]}]', (0, 0, 1)), ('["x","<NO SQL GENERATE>"]', (0, 0, 0)), ('"y"', (0, 0, 0)), ("[]", (0, 0, 0)), ('["a",{"type":"NO_SQL_GENERATE"}]', (0, 0, 1))]
GAPS = [
    ('["SELECT ...","ok",{"variants":[{"sql":"a [其他 b"},{"scenario":"s"}]},{"x":1},["..."]]', '["不完整SQL语句: SELECT ...","ok",{"variants":[{"sql":"不完整SQL语句: a [其他 b"},{"scenario":"s"}]},{"x":1},["..."]]'),
    ("SELECT 1 FROM t; UPDATE 其他] x;", '["SELECT 1 FROM t;","不完整SQL语句: UPDATE 其他] x;"]'),
    ('["fine"]', '["fine"]'),
]
PATTERNS = [('["A",{"description":"about"},{"type":"x"}]', ["A", "about"]), ('["B",["C"],5]', ["B"]), ('"D"', [])]
LINES = [
    ('["SELECT a",{"type":"param_dependent","variants":[{"scenario":"s","sql":"X"},{"sql":"Y"},{}]},{"k":1}]', "  1. SELECT a\n  1. s: X\n  2. 变体2: Y\n  3. 变体3: \n  3. {\"k\":1}"),
    ('"just a text"', "just a text"), ("[]", "[]"), ('{"k":2}', '{"k":2}'),
]
EXAMPLES = [
    ('{"code_key":"k","code_file":"f","in":[{"code_label":1,"x":{"code_type":2,"y":{"code_start_line":3,"z":[4,{"code_version":"v"}]}}}]}', '{"code_key":"k","in":[{"x":{"y":{"z":[4,{}]}}}]}'),
    ("[1,null,\"code_file\"]", '[1,null,"code_file"]'),
]


def of(spark: SparkSession, sf_dir: str, texts: list[str]) -> DataFrame:
    """(record_id, statement_list)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.expr(nth(texts, "o_orderkey")).alias("statement_list"))


def records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records with raw lists, removals, additions); a method's caller is one of 32."""
    rows = of(spark, sf_dir, LISTS).withColumns({"orm_code": F.concat(F.lit("m"), F.col("record_id") % 8), "caller": F.concat(F.lit("c"), F.floor(F.col("record_id") / 8) % 4)})
    keys = rows.select("orm_code", "caller").distinct()
    says = lambda callers, sql: keys.where(F.col("caller").isin(*callers)).withColumn("sql_text", F.lit(sql))
    return rows, says(["c1", "c3"], "DELETE b"), says(["c2", "c3"], "NEW 1").unionByName(says(["c3"], "NEW 2"))
