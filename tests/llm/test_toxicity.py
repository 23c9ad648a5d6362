"""Nearest-example toxicity scores against brute force and held-out rows."""

import random
import tracemalloc

import numpy as np


def test_index_is_exact():
    from spark_ledger.llm.toxicity import BlockMaxIndex, vector
    rnd, idf = random.Random(1), np.linspace(1, 4, 12)
    for n in (0, 1, 63, 64, 300):
        vectors = [vector({t: rnd.randint(1, 3) for t in rnd.sample(range(12), rnd.randint(1, 4))}, idf) for _ in range(n)]
        index = BlockMaxIndex(vectors, 12)
        for _ in range(20):
            t, w = vector({t: 1 for t in rnd.sample(range(12), 3)}, idf)
            dense = [(round(sum(x * dict(zip(vt.tolist(), vw.tolist())).get(i, 0) for i, x in zip(t.tolist(), w.tolist())), 12), e)
                     for e, (vt, vw) in enumerate(vectors)]
            want = sorted((x for x in dense if x[0] > 0), key=lambda x: (-x[0], x[1]))[:7]
            got = index.nearest(t, w, 7)
            assert np.allclose([s for s, _ in got], [s for s, _ in want], atol=1e-9)
            assert all(dict((e, s) for s, e in dense)[e] > 0 for _, e in got) and len(got) == len(want)


def test_scores(spark):
    from spark_ledger.llm.toxicity import fit, score
    rnd, rows = random.Random(2), [(-1, None, 0, 1), (-2, "", 0, 0), (-3, " \n", 0, 0)]
    plain = [f"w{chr(97 + i)}{chr(97 + j)}x" for i in range(20) for j in range(10)]
    for i in range(500):
        toxic = int(rnd.random() < .3)
        words = rnd.choices(plain, k=rnd.randint(5, 60))
        if toxic:
            words.insert(3, rnd.choice(["Idiot", "moron!", "rotzig" + rnd.choice(plain)]))
        rows.append((i, " ".join(words), toxic, 0))
    rows += [(900, "word " * 40000 + "idiot", 1, 0), rows[5]]
    docs = spark.createDataFrame([(a, b, "clash") for a, b, _, _ in rows], "doc_id long, text string, toxic string").drop("toxic")
    labels = spark.createDataFrame([(a, c) for a, _, c, _ in rows if a % 3 != 1] + [(None, 1), (5000, 1), (7, None)], "doc_id long, toxic int")
    model = fit(docs, labels)
    got = score(docs, model).collect()
    assert len(got) == len(rows)
    truth = {a: c for a, _, c, _ in rows}
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] % 3 == 1 or r["doc_id"] < 0]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= .98 * len(held)
    assert next(r for r in got if r["doc_id"] == 900)["predicted"] == 1
    value, near = model.evidence("what an idiot")
    assert value >= .7 and near and len(near) <= 15
    assert score(docs.limit(0), model).count() == 0
    assert {r["score"] for r in score(docs, fit(docs, labels.limit(0))).collect()} == {0.5}
    one = fit(docs, labels.where("toxic = 0"))
    assert all(r["predicted"] == 0 for r in score(docs, one).collect())


def test_all_terms_of_the_examples_count(spark):
    from spark_ledger.llm.toxicity import fit, score
    rnd, rows = random.Random(5), []
    plain = [f"w{chr(97 + i)}{chr(97 + j)}x" for i in range(20) for j in range(10)]
    loud = [f"{chr(97 + i)}{chr(97 + j)}bozo" for i in range(10) for j in range(20)]     # many frequent insults
    for i in range(1200):
        toxic = int(i % 3 == 0)
        words = rnd.choices(plain, k=20)
        if toxic:
            words[3:3] = ["idiot"] + rnd.choices(loud, k=5) if i % 60 else ["zqrvk"]      # a rare one, 20 texts
        rows.append((i, " ".join(words), toxic))
    rows += [(5000 + i, " ".join(rnd.choices(plain, k=20) + ["zqrvk"]), None) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([(a, c) for a, _, c in rows if c is not None], "doc_id long, toxic int"))
    assert {"zqrvk", "idiot", *plain} <= set(model.terms)
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    assert all(got[5000 + i]["predicted"] == 1 for i in range(20))
    clean = model.evidence(rows[1][1])
    assert len(clean[1]) == 15 and clean[0] < .5                                       # clean texts have neighbours


def test_counts_of_many_texts_equal_those_of_each():
    import random

    from spark_ledger.llm.toxicity import WordTerms, terms_of
    rnd = random.Random(2)
    words = ["a", "Idiot", "idiots", "İdiot", "straße", "日本語", "no1", "x_y", "\0", "don't", "ÉTÉ", "q\0r"]
    texts = ["", " ".join(words)] + [" ".join(rnd.choices(words, k=rnd.randint(0, 30))) for _ in range(200)] + [""]
    terms = sorted({t for x in texts for t in terms_of(x)})[::2]
    table = WordTerms(terms)
    got = table.counts_many(texts)
    assert len(got) == len(texts) and table.counts_many([]) == []
    for text, (t, n) in zip(texts, got):
        one = table.counts(text)
        assert t.tolist() == one[0].tolist() and n.tolist() == one[1].tolist()
        assert {terms[i]: c for i, c in zip(t.tolist(), n.tolist())} == {x: c for x, c in terms_of(text).items() if x in set(terms)}


def test_the_index_is_made_without_a_second_copy_of_the_vectors():
    from spark_ledger.llm.toxicity import BlockMaxIndex
    rng = np.random.default_rng(3)

    def vectors():
        for _ in range(3000):
            t = np.unique(rng.integers(0, 30_000, 400))
            w = rng.random(len(t))
            yield t, w / np.linalg.norm(w)

    tracemalloc.start()
    index = BlockMaxIndex(vectors(), 30_000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))
    assert index.n == 3000 and most < 1.25 * held
    rng = np.random.default_rng(3)
    every = list(vectors())
    dense = np.zeros((3000, 30_000))
    for i, (t, w) in enumerate(every):
        dense[i, t] = w
    for q in (0, 1, 2999):
        want = sorted(((round(float(s), 9), -e) for e, s in enumerate(dense @ dense[q]) if s > 0), reverse=True)[:7]
        assert [(round(s, 9), -e) for s, e in index.nearest(*every[q], 7)] == want


def test_light_terms_are_summed_for_few_examples_and_the_nearest_stay_exact(monkeypatch):
    from spark_ledger.llm.toxicity import BlockMaxIndex, weighted
    rng = np.random.default_rng(4)
    scale = np.concatenate([np.full(300, .02), rng.uniform(.5, 2, 4700)])             # 300 frequent terms weigh little

    def vectors(n):
        for _ in range(n):
            t = np.unique(np.concatenate([rng.choice(300, 150, replace=False), 300 + rng.integers(0, 4700, 40)]))
            yield weighted(t, rng.integers(1, 5, len(t)).astype(float), scale)

    every, queries = list(vectors(1500)), list(vectors(40)) + [weighted(np.arange(5), np.ones(5), scale)]
    dense = np.zeros((1500, 5000))
    for i, (t, w) in enumerate(every):
        dense[i, t] = w
    index, compared, sums = BlockMaxIndex(every, 5000), [], BlockMaxIndex._sums
    monkeypatch.setattr(BlockMaxIndex, "_sums", lambda self, some, size: compared.append(len(some)) or sums(self, some, size))
    for i, (t, w) in enumerate(queries):
        want = sorted(((round(float(s), 9), -e) for e, s in enumerate(dense[:, t] @ w) if s > 0), reverse=True)[:15]
        assert [(round(s, 9), -e) for s, e in index.nearest(t, w, 15)] == want
    assert sum(compared) < len(queries) * 1500 / 5


def test_portions_and_words():
    from spark_ledger.llm.toxicity import _WORD, portions, words_of
    texts = ["a" * 9, "", "b", "c" * 30, "d", "e"]
    assert list(portions(texts, 2, 10)) == [texts[:2], texts[2:3], texts[3:4], texts[4:]]
    assert list(portions([])) == []
    odd = "".join(map(chr, range(256))) + " Ünï_cöde² x\x85y\xa0z"
    for text in (odd, odd + " Σίσυφος ΟΔΟΣ 日本語", ""):
        assert words_of([text]) == _WORD.findall(text.lower()) + ["\0"]
