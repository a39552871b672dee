"""The prefix trie against brute force: nulls, ties, copies, turnless conversations, one long conversation."""

import hashlib
import re
import zlib

import duckdb

from statloom.llm import prefix_trie, queries
from statloom.session import Scratch

SF = "/root/testdata/sf0.001"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[x] for x in below) or 1
        own_words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = (len(nodes[path]) - 1) * own_words + sum(saved[x] for x in below)
    out = []
    for path, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(paths[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3) if isinstance(rows, list) else rows
    return sorted((tuple(r) for r in prefix_trie.trie(spark, df, Scratch(spark)).collect()), key=str)


def test_against_brute_force_and_sql(spark):
    got = queries.op13_prefix_trie(spark, SF)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    sql = con.sql(prefix_trie.ORACLE)
    assert got.columns == sql.columns
    got = sorted(map(tuple, got.collect()), key=str)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute_trie(rows) == sorted(sql.fetchall(), key=str)


def odd_rows():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}  of\tall") for c in range(100, 118) for t in range(5)]  # copies
    rows += [(c, t, "user", f"turn {t}  of\tall" if t < 4 else f"own {c}") for c in range(118, 124) for t in range(6)]
    rows += [(c, 0, None, None) for c in range(200, 210)]  # turnless once their block's first conversation is missing
    rows += [(300, None, "user", "first"), (300, None, "system", "before it"), (300, 2, "user", "x"), (300, 2, "user", "x"), (301, 1, None, "no role"), (301, 0, "user", None)]
    rows += [(None, 0, "user", "of no conversation")] * 3
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401, t, "user", f"long {t}") for t in range(300)]
    return rows


def test_odd_rows(spark):
    assert made(spark, odd_rows()) == brute_trie(odd_rows())


def test_deep_shared_turns(spark):
    rows = [(c, t, "user", f"w {t}" if t < 7 else f"{c}") for c in range(20, 26) for t in range(8 + c % 2)]
    assert made(spark, rows) == brute_trie(rows)


def test_all_equal_or_single(spark):
    for rows in ([(c, 0, "user", "same words") for c in range(1, 9)], [(5, 0, "user", "a b"), (5, 1, "user", "c")], [(61, 0, "user", "x")]):
        assert made(spark, rows) == brute_trie(rows)


def test_empty_table_and_clashing_columns(spark):
    assert made(spark, []) == []
    rows = odd_rows()[:60]
    df = spark.createDataFrame([(*r, 1, 2, "d") for r in rows], CONVERSATIONS + ", depth int, pos int, digest string")
    assert made(spark, df) == brute_trie(rows)


def test_members_stream_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert made(spark, spark.createDataFrame(odd_rows(), CONVERSATIONS).repartition(2)) == brute_trie(odd_rows())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
