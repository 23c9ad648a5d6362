"""The prefix trie against brute force and DuckDB."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(role, text):
    return hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, key(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append((c, len(path) == d))
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    first = {p: min(c for c, _ in m) for p, m in nodes.items()}
    return sorted((first[p], len(p), first[p[:-1]] if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest()) for p, m in nodes.items())


def made(seed, convs=60):
    rnd, rows = random.Random(seed), []
    for c in range(0, convs * 2, rnd.choice([1, 1, 2])):
        if rnd.random() < .1:
            continue
        for turn in range(rnd.randint(1, 12)):
            text = rnd.choice(["hi", "hi", "hi", "ça va", "", None, "b" * rnd.randint(1, 3)])
            rows.append((c, turn if rnd.random() < .95 else None, rnd.choice(["user", "user", "bot", None]), text, "x", 1))
    rows += [(500 + c, t, "user", "copy", "x", 1) for c in range(0, 80) for t in range(9)]
    rows += [(1000, t, "user", f"long {t // 2}", "x", 1) for t in range(300)] + [(None, 1, "user", "nobody", "x", 1)]
    return rows + rows[:3]                                   # repeated rows


def as_rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed,shard", [(1, 50_000), (2, 1), (3, 7), (4, 60)])
def test_equals_brute_force(spark, seed, shard):
    from spark_ledger.llm import prefix_trie as m
    rows = made(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert as_rows(m.prefix_nodes(docs, shard)) == brute(rows)


def test_sql(spark):
    from spark_ledger.llm.prefix_trie import oracle_sql, prefix_nodes
    rows = made(8, 30)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, depth VARCHAR, n INT)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?, ?)", rows)
    res = con.execute(oracle_sql())
    order = [[d[0] for d in res.description].index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in order) for r in res.fetchall()) == brute(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert as_rows(prefix_nodes(docs)) == brute(rows)


def test_empty_and_turnless(spark):
    from spark_ledger.llm.prefix_trie import prefix_nodes
    docs = spark.createDataFrame([], SCHEMA)
    assert prefix_nodes(docs).count() == 0
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)    # no first conversation: no turn is left
    rows = [(alone, 0, "user", "gone", "x", 1)]
    assert as_rows(prefix_nodes(spark.createDataFrame(rows, SCHEMA))) == brute(rows) != []


def test_double_array():
    from spark_ledger.llm.prefix_trie import DoubleArray
    rnd = random.Random(5)
    for _ in range(50):
        seqs = sorted({tuple(rnd.randrange(rnd.choice([2, 9, 60])) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(0, 80))})
        trie, prefixes = DoubleArray.build([list(s) for s in seqs]), {s[:i] for s in seqs for i in range(len(s) + 1)}
        seen = {}
        for p in prefixes | {s + (1,) for s in seqs} | {(61,), (5, 5, 5)}:
            state = 0
            for x in p:
                state = trie.go(state, x) if state >= 0 else -1
            assert (state >= 0) == (p in prefixes or p == ())
            seen.setdefault(state, set()).add(p)
        assert all(len(v) == 1 for s, v in seen.items() if s >= 0)
