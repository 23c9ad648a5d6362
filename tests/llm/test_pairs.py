"""Similarity joins, components and the pipeline against brute force."""

import random

import duckdb
import numpy as np
import pytest


def table(spark, texts, ids=None, extra="component_id"):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, 7) for i, t in zip(ids, texts)], f"doc_id long, text string, {extra} long")


def roots_of(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components(spark):
    from spark_ledger.llm.components import components
    rnd = random.Random(1)
    links = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(70)] + \
        [(200, 201 + i) for i in range(50)] + [(5, 5), (None, 3), (100, 101)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = roots_of(300, real)
    assert got == {i: want[i] for e in real for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def copies(rnd, words, n, size, edits):
    base = rnd.choices(words, k=size)
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randint(0, edits)):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("block", [512, 8])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    from spark_ledger.llm import ngram_join
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd, words = random.Random(block), [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n", "one", "One", "a b c d", "A  b c\td", "a b c", "a b c d e", "x " * 4000, "x " * 40, "é É x y z"]
    line = " ".join(rnd.choices(words, k=30))
    for size, n, edits in ((20, 6, 2), (60, 12, 2), (60, 20, 4), (200, 25, 5), (90, 30, 6)):
        texts += copies(rnd, words, n, size, edits)
    texts += [line + " " + " ".join(rnd.choices(words, k=rnd.choice([3, 6, 9, 200]))) for _ in range(30)]
    texts.append(texts[40])
    ids = [3 * i - 20 for i in range(len(texts))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(table(spark, texts, ids)).collect()}
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(i, j) for j in range(len(texts)) for i in range(j)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = roots_of(len(texts), links)
    assert got == {ids[i]: (len(sets[i]), ids[want[i]]) for i in range(len(texts))}
    assert ngram_join.near_duplicates(table(spark, texts).limit(0)).count() == 0


def test_tree_bounds_lose_nothing():
    from spark_ledger.llm.ngram_join import overlaps, signature, tree_links
    rnd = np.random.default_rng(2)
    for _ in range(15):
        base = [np.unique(rnd.integers(0, 2**63, rnd.integers(3, 300)).astype(np.uint64)) for _ in range(6)]
        sets = []
        for b in base:
            for _ in range(rnd.integers(1, 12)):
                keep = b[rnd.random(len(b)) > rnd.choice([0, .05, .15])]
                sets.append(np.unique(np.concatenate([keep, rnd.integers(0, 2**63, rnd.integers(0, 9)).astype(np.uint64)])))
        sets = [s for s in sets if len(s)]
        want = {(i, j) for j in range(len(sets)) for i in range(j) if overlaps(sets[i], sets[j])}
        n = np.array([len(s) for s in sets])
        may = {tuple(sorted(p)) for p in tree_links(n, np.arange(len(sets)), [signature(s) for s in sets])}
        assert want <= may
        span = tree_links(n, np.arange(len(sets)), [signature(s) for s in sets], lambda i, j: overlaps(sets[i], sets[j]))
        assert {tuple(sorted(p)) for p in span} <= want and roots_of(len(sets), span) == roots_of(len(sets), want)


def test_e8_decoder_finds_the_nearest_point():
    from spark_ledger.llm.embedding_dedup import STEPS, e8_decode
    assert len(STEPS) == 240 and np.allclose((STEPS**2).sum(axis=1), 2)
    x = np.random.default_rng(3).normal(0, 2, (500, 8))
    twice, d = e8_decode(x)
    p = twice / 2
    assert np.allclose(((x - p) ** 2).sum(axis=1), d) and (d <= 1 + 1e-9).all()          # covering radius 1
    assert ((x[:, None] - p[:, None] - STEPS[None]) ** 2).sum(axis=2).min() >= 0
    assert (((x[:, None] - p[:, None] - STEPS[None]) ** 2).sum(axis=2).min(axis=1) >= d - 1e-9).all()
    assert (twice.sum(axis=1) % 4 == 0).all()


@pytest.mark.parametrize("rows", [2048, 40])
def test_near_vectors_equal_brute_force(spark, monkeypatch, rows):
    from spark_ledger.llm import embedding_dedup
    monkeypatch.setattr(embedding_dedup, "ROWS", rows)
    rnd = np.random.default_rng(4)
    data, at = [], 0
    for k in range(60):
        base = rnd.standard_normal(64)
        for _ in range(rnd.choice([1, 1, 2, 9])):
            x = base + rnd.standard_normal(64) * rnd.choice([0, .05, .12, .25])
            data.append((7 * at - 9, [float(v) for v in np.float32(x * rnd.choice([1, 3]))]))
            at += 1
    bad = [None, [], [0.0] * 64, [float("nan")] * 64, [1.0] * 63 + [None], [float("inf")] + [0.0] * 63]
    data += [(100000 + i, v) for i, v in enumerate(bad)] + [(200000, [1.0, 2.0]), (200001, [1.0, 2.01]), (200002, [1.0] * 16)]
    data.append((300000, data[0][1]))
    emb = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<float>, n_links int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(emb).collect()}
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for _, v in data]
    unit = [np.array(v) / np.linalg.norm(v) if k else None for (_, v), k in zip(data, ok)]
    links = [(i, j) for j in range(len(data)) for i in range(j)
             if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= .95]
    root, n = roots_of(len(data), links), [0] * len(data)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    assert got == {data[i][0]: (n[i], data[root[i]][0], root[i] == i) for i in range(len(data))}
    assert embedding_dedup.near_vectors(emb.limit(0)).count() == 0
    none = {r["n_links"] for r in embedding_dedup.near_vectors(emb.where("vec_id in (100000, 100002)")).collect()}
    assert none == {0}


def test_jaccard_join_without_and_with_shared_ids(spark):
    """Null ids belong to no component; rows of one id are one document."""
    from spark_ledger.llm.ngram_join import near_duplicates
    rnd, words = random.Random(3), [f"w{i}" for i in range(900)]
    a, b, c = (" ".join(rnd.choices(words, k=60)) for _ in range(3))
    rows = [(1, a), (2, a + " tail"), (2, b), (3, b + " tail"), (None, a), (None, c), (4, c), (4, c), (5, "alone"), (5, ""), (None, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (None, None), (4, 4), (5, 5)}
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] is None) == [0, 56, 56]


def test_packed_sets_round_trip():
    from spark_ledger.llm.ngram_join import packed, unpacked
    s = np.sort(np.random.default_rng(1).integers(0, 2**64, 100, np.uint64))
    assert (unpacked(packed(s)) == s >> np.uint64(16) << np.uint64(16)).all() and len(packed(s)) == 600 and len(unpacked(b"")) == 0


def test_large_groups_of_like_texts_leave_links_only(spark):
    import pyarrow as pa

    from spark_ledger.llm import ngram_join as J
    from spark_ledger.llm.words import WordHashes
    # one passage of 70 % in every text, and two copies of each tail but for a word: pairs of one tail link, others are alike only
    passage = [f"p{i}" for i in range(74)]
    texts = [" ".join(passage + [f"t{k // 2}x{i}" for i in range(19)] + [f"e{k}"]) for k in range(160)]
    sets = [J.token_set(t, WordHashes()) for t in texts]
    ids = list(range(160))
    group = pa.table({"doc": pa.array(ids, pa.int64()), "comp": pa.array(ids, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()),
                      "tokens": [J.packed(s) for s in sets], "sig": [J.signature(s).tobytes() for s in sets]})
    got = J._second_links(group).to_pylist()
    assert {(min(r.values()), max(r.values())) for r in got} == {(k, k + 1) for k in range(0, 160, 2)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((k, len(sets[k]), k - k % 2) for k in ids)
    assert sorted(tuple(r) for r in J.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()) == want


def test_rows_of_tokens_are_written_compressed_and_given_back(spark, monkeypatch):
    from spark_ledger.llm import ngram_join as J
    rnd, words, given, give = random.Random(6), [f"w{i}" for i in range(500)], [], J.release
    monkeypatch.setattr(J, "release", lambda s, *paths: given.extend(paths) or give(s, *paths))
    texts = copies(rnd, words, 20, 80, 4) + copies(rnd, words, 20, 60, 4)
    got = {r["component_id"] for r in J.near_duplicates(table(spark, texts)).collect()}
    assert {0, 20} <= got
    kinds = [p.rsplit("/llm-", 1)[1].rsplit("-", 1)[0] for p in given]
    assert sorted(kinds) == ["rows", "rows", "sets", "shingles"]
    fs = spark._jvm.org.apache.hadoop.fs.Path(given[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p)) for p in given)


def test_large_sets_in_mixed_groups_are_told_apart_by_their_own_signatures():
    """A tree folds signatures to those of its smallest set; pairs that remain are
    looked at by as many bits as both have before any set moves."""
    from spark_ledger.llm import ngram_join as J
    rng = np.random.default_rng(3)
    sizes = [64]
    while sizes[-1] < 2000:
        sizes.append(sizes[-1] * 6 // 5)
    sets = [np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in sizes]
    far, near = sets[-1].copy(), sets[-1].copy()
    far[::3], near[::50] = rng.integers(0, 2**63, len(far[::3])), rng.integers(0, 2**63, len(near[::50]))
    sets += [np.sort(far), np.sort(near)]
    n, last = np.array([len(s) for s in sets], np.int64), len(sizes) - 1
    got = {tuple(sorted(x)) for x in J.tree_links(n, np.arange(len(sets)), [J.signature(s) for s in sets])}
    assert got == {(last, last + 2)}


def test_sets_in_buckets_do_not_travel(spark):
    from spark_ledger.llm.common import bucketed, drop_bucketed, release, shared_path
    path = shared_path(spark, "sets")
    held = bucketed(spark.range(5000).selectExpr("id AS doc", "repeat('x', 50) AS tokens"), path, "doc")
    j = spark.range(0, 10000, 2).selectExpr("id AS doc").repartition(3).join(held.hint("merge"), "doc")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc") == 1 and "Bucketed: true" in plan
    assert j.count() == 2500
    drop_bucketed(spark, path)
    release(spark, path)
