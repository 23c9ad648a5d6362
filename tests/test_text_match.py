"""The q-gram index against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from spark_ledger.operators import rules
from spark_ledger.operators.text_match import match_texts, required_literal

REGEXES = ["brand#1[0-9]", "(red|blue) widget", "ab+c", "abc?", "abcd?ef", "ab{2}cde", "^hello", "hello$", "a.c", ".*", "", r"\d{3}", r"foo\.bar",
           "x(yz)?foo", "x(yz)foo", "[abc]def", r"\bcoffee\b", "(?i)coffee", r"\x41bcd", r"\p{L}abc", "colou?r", "a|bcd", "abc*?def", "ab++cd",
           "tea(cup)+", "café bar", "(?:shop) here", "[[abc]def]xyz", r"\Qa.b\E"]
TEXTS = ["brand#12 store", "blue widget", "abbbc", "ab", "abcef", "abbcde", "hello", "say hello", "hello you", "axc", "", "tel 123", "foo.bar", "fooxbar",
         "xfoo", "xyzfoo", "cdef", "coffee", "coffees", "abcd", "éabc", "color", "colour", "bcd", "abdef", "abccdef", "abbcd", "teacupcup", "café bar",
         "shop here", "adefxyz", "a.b", "Abcd"]


def test_literals_are_required(spark):
    df = spark.createDataFrame([(r,) for r in REGEXES], "r string").select("r", required_literal(F.col("r")).alias("l"))
    got = {r.r: r.l for r in df.collect()}
    assert got["brand#1[0-9]"] == "brand#1" and got["abcd?ef"] == "abc" and got["ab+c"] == "ab" and got["(red|blue) widget"] is None
    assert got[r"foo\.bar"] in ("foo", "bar") and got["x(yz)foo"] == "foo" and got["x(yz)?foo"] is None and got[r"\x41bcd"] is None


def test_equals_brute_force(spark):
    pats = spark.createDataFrame([(i, "regex", r) for i, r in enumerate(REGEXES)] + [(100 + i, "contains", t) for i, t in enumerate(TEXTS)]
                                 + [(300, "other", "ab"), (301, "regex", None)], "pid int, kind string, pattern string")
    texts = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string").distinct()
    got = {(r.t, r.pid) for r in match_texts(texts, "t", pats).select("t", "p.pid").collect()}
    java = spark.createDataFrame([(t,) for t in TEXTS], "t string").crossJoin(
        pats.where("kind = 'regex' and pattern is not null")).where("regexp_like(t, pattern)")
    want = {(r.t, r.pid) for r in java.select("t", "pid").collect()} | {(t, 100 + i) for t in TEXTS for i, p in enumerate(TEXTS) if p in t}
    assert got == want


@pytest.mark.parametrize("n", [20_000])
def test_many_rules_without_nested_loops(spark, n):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(4, 7)))
    pats = [word() for _ in range(n)]
    texts = [" ".join(rnd.choice([word(), rnd.choice(pats)]) for _ in range(4)) for _ in range(400)]
    r = spark.createDataFrame([("contains" if i % 2 else "regex", p, f"C{i}", i % 50, "no") for i, p in enumerate(pats)],
                              "match_type string, pattern string, category string, priority int, subscription string")
    tx = spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "txn_id string, description string, category string")
    out = rules.categorize(tx, r, method="join")
    plan = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert not re.search("NestedLoop|Cartesian", plan)
    got = {x.txn_id: x.category for x in out.collect()}
    for i, t in enumerate(texts):
        hits = [(j % 50, -len(p), f"C{j}") for j, p in enumerate(pats) if p in t]
        assert got[str(i)] == (min(hits)[2] if hits else "Uncategorized")
