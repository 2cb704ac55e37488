"""The conversations' trie against a plain one."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from loomspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, family int"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    for own in convs.values():
        own.sort()
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(t[2:] for t in convs.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = Counter(), Counter()
    for p in members:
        worth = (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += worth
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p)))).encode()).hexdigest())
        for p, m in list(members.items())
    )


def made():
    rng = random.Random(9)
    says = ["hello there", "what  is\tit", "yes", "no no no", "", None, "中文 text", "hello there "]
    rows = []
    for c in [*range(0, 70), 101, 119, 240, -3, -25, -40, 10**15 + 7]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", None]), rng.choice(says[: 3 if t < 2 else 8]), "x", 1))
    rows += [(500, 0, "user", "same", "x", 1)] * 30  # repeated rows are turns
    rows += [(501, 3, "user", "b", "x", 1), (501, 3, "user", "a", "x", 1), (None, 1, "user", "nobody", "x", 1)]
    rows += [(c, t, "user", "copied", "x", 1) for c in range(600, 680) for t in range(6)]
    return rows


@pytest.mark.parametrize("segment", [3, 4096])
def test_against_a_plain_trie(spark, segment):
    rows = made()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(map(tuple, prefix_trie.prefix_trie(turns, segment).collect()))
    assert got == plain(rows)


def test_one_conversation_over_many_ranges(spark):
    """Places, keys and sums hold where one conversation has nearly all rows."""
    rows = [(7, t, "user", f"turn {t % 11}", "x", 1) for t in range(400)] + [(8, t, "user", f"turn {t % 11}", "x", 1) for t in range(390)] + [(3, 0, None, None, "x", 1)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    placed = prefix_trie.numbered(turns).where("conv_id = 7")
    assert sorted(r.pos for r in placed.collect()) == list(range(1, 401))
    assert Counter(map(tuple, prefix_trie.prefix_trie(turns, 50).collect())) == plain(rows)


def test_many_identifiers_of_one_node(spark, monkeypatch):
    """Identifiers of a node stream through one digest, range by range."""
    monkeypatch.setattr(prefix_trie, "RANGE_BITS", 5)
    rows = [(c, t, "user", "equal", "x", 1) for c in range(0, 3000, 7) for t in range(4)]
    got = Counter(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == plain(rows)


def test_no_rows(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "x", 1)], SCHEMA)).collect() == []


def test_query_and_sql(spark):
    import duckdb

    from loomspark.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    got = queries.op13_prefix_trie(spark, sf)
    cols = sorted(got.columns)
    rel = con.sql(queries.SQL["op13_prefix_trie"])
    assert sorted(rel.columns) == cols
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = plain(map(tuple, turns))
    assert Counter(map(tuple, got.collect())) == want == Counter(rel.select(*got.columns).fetchall())
