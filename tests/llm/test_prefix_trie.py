"""The conversation prefix trie against its SQL twin and plain loops."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from atlasmith.llm import prefix_trie

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth string, path int, k1 double"


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def brute(rows, rebuild=True):
    """Nodes of (conv_id, turn, role, text) by plain loops."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    made = own
    if rebuild:
        made = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = lambda node: [x for x in members if x[: len(node)] == node]
    children = {node: [x for x in members if len(x) == len(node) + 1 and x[: len(node)] == node] for node in members}
    out = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(made[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below(node) if x)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children[node]), sum(not children[x] for x in below(node)), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_equals_sql_and_loops(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    want = con.sql(prefix_trie.ORACLE)
    at = [want.columns.index(c) for c in COLUMNS]
    got = result(prefix_trie.op13_prefix_trie(spark, SF))
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    rows = con.sql("select conv_id, turn, role, text from conversations").fetchall()
    assert got == brute(rows)


ROWS = [
    # Equal conversations, one that is another's start, ids of several pieces, and hot first turns.
    *((c, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for c in (1, 2, 3, 5000, 70_000) for t in range(3)),
    (4, 0, "user", "t0"), (4, 1, "assistant", "t1"), (6, 0, "user", "other"), (100, 2, "user", "late"), (100, None, None, None), (100, 1, "x", "é🙂"), (101, 0, "user", "q"), (199, 0, "user", "q"), (199, 1, "", ""),
    # No block head: few own turns, so that none may be left.
    *((c, 0, "user", "only") for c in range(300, 330) if c != 300), (None, 0, "user", "lost"), (7, 0, "user", "twice"), (7, 0, "user", "twice"), (400, 0, "user", "w" * 100_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "clash", 1, 0.5) for r in ROWS], SCHEMA)


@pytest.mark.parametrize(("cut", "crowd"), [(8, 1 << 20), (1, 1 << 20), (0, 1 << 20), (1, 1)])
def test_odd_rows(spark, odd, monkeypatch, cut, crowd):
    """Peeled by levels, in tasks, and by a cut that goes deeper as many share it."""
    monkeypatch.setattr(prefix_trie, "CUT", cut)
    monkeypatch.setattr(prefix_trie, "CROWD", crowd)
    assert result(prefix_trie.conversation_trie(odd)) == brute(ROWS, rebuild=False)
    assert result(prefix_trie.trie(prefix_trie.sequences(prefix_trie.shared_heads(prefix_trie.numbered(odd))))) == brute(ROWS)


def test_long_conversations(spark):
    """Long ones that share long starts, one that is another's start, and copies."""
    turns = lambda c, n, own: [(c, t, "user", f"own{c}x{t}" if t >= own else f"s{t}") for t in range(n)]
    rows = [x for c, n, own in ((1, 40, 40), (2, 40, 40), (3, 30, 40), (4, 45, 25), (5, 60, 25), (6, 9, 8), (7, 3, 1), (8, 8, 40), (9, 10, 40)) for x in turns(c, n, own)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(prefix_trie.conversation_trie(docs)) == brute(rows, rebuild=False)


def test_crowded_parents_by_broadcast(spark, odd):
    nodes = prefix_trie.peeled(prefix_trie.ended(prefix_trie.sequences(prefix_trie.numbered(odd).selectExpr("*", "1 as part"))))
    rows = [sorted((r["depth"], r["conv_id"], r["parent_conv_id"]) for r in prefix_trie.with_parents(nodes, hot).where("depth > 0").collect()) for hot in (1, 2, 1 << 16)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == nodes.count() - 1


def test_empty_table(spark, odd):
    for make in (prefix_trie.conversation_trie, lambda d: prefix_trie.trie(prefix_trie.sequences(prefix_trie.shared_heads(prefix_trie.numbered(d))))):
        out = make(odd.limit(0))
        assert out.columns == COLUMNS and out.collect() == []
