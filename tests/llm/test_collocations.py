"""Phrase collocations against brute force and DuckDB."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, phrase string"


def brute(rows, max_words, min_count, overlap, keep):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(100 * b >= overlap * a for q, b in cand.items() if len(q) > len(p)
                         and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, le, r) in enumerate(sorted(kept)[:keep], 1):
            out.add((lang, rank, p.decode(), -a, le, r, n[lang], -score))
    return out


def made(seed, texts=160):
    rnd = random.Random(seed)
    words = ["New", "york", "city", "the", "of", "Été", "a", "b", "日本", "x-y", "\xa0z", "ÀB"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]
    rows = []
    for i in range(texts):
        text = "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(0, 40)))
        if i % 3 == 0:
            text += "new york city the "
        rows.append((i if i % 5 else None, text, rnd.choice(["en", "fr", None, "und", ""]), "clash"))
    return rows + [(1, None, "en", None), (2, "", None, None), (3, "one", "de", None), (4, "ab " * 20000, "long", None)]


@pytest.mark.parametrize("max_words,min_count,keep", [(3, 10, 2000), (2, 3, 5), (4, 5, 40), (3, 300, 10)])
def test_equals_brute_force(spark, max_words, min_count, keep):
    from spark_ledger.llm.collocations import collocations
    rows = made(max_words)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in collocations(docs, max_words, min_count, 50, keep).collect()]
    want = brute([(r[2], r[1]) for r in rows], max_words, min_count, 50, keep)
    assert len(got) == len(set(got)) and set(got) == want and got


def test_many_buckets_and_early_sums_change_nothing(spark, monkeypatch):
    from spark_ledger.llm import collocations as m
    docs = spark.createDataFrame(made(9), SCHEMA).repartition(4)
    want = {tuple(r) for r in m.collocations(docs).collect()}
    for name, value in (("BUCKET_BYTES", 500), ("HELD", 50), ("SLICE_BYTES", 300)):
        monkeypatch.setattr(m, name, value)
    assert {tuple(r) for r in m.collocations(docs).collect()} == want


def test_sql_and_empty(spark):
    from spark_ledger.llm.collocations import collocations, oracle_sql
    rows = made(7)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, phrase VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in collocations(docs).collect()} == set(con.execute(oracle_sql()).fetchall())
    assert collocations(docs.limit(0)).count() == 0


def test_exact_beyond_64_bits(spark):
    """Products of large counts stay exact."""
    row = spark.range(1).selectExpr("cast(4000000000 as decimal(15,0)) a", "cast(4000000007 as decimal(15,0)) l",
                                    "cast(5000000011 as decimal(15,0)) r").selectExpr("(a * a * 1000000) div (l * r) score").first()
    assert row[0] == 1000000 * 4000000000 ** 2 // (4000000007 * 5000000011)
