"""The lexicon, the merges and op12 against the library and brute force."""

import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

PIECES = ["a", "B", "é", "ß", "É", " ", "  ", "\n", "\t", ".", ",", "'", "'s", "12", "日本", "▁", "　", "́", "$", "don't ", "The ",
          "word ", "<|endoftext|>", "<|startoftext|>", "😀", "\r\n", "—", " x", "LL", "\0", "İ", "ǅ", "zqxj", "aaaaaaa", "\u0085", "\x1c", "</w>"]


def texts(n, seed=0):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 20))) for _ in range(n)] + ["", " ", "x " * 3000, "ab" * 5000, "q" * 300]


def lexicon_of(words, tmp_path):
    from spark_ledger.llm.lexicon import Lexicon, Merges
    words = sorted(set(words))
    flat, lens = Merges(PATH).encode(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64))
    Lexicon.write(str(tmp_path / "lex.bin"), words, flat, lens)
    return Lexicon(str(tmp_path / "lex.bin"))


def test_automaton_is_minimal_and_numbers_words(tmp_path):
    from spark_ledger.llm.lexicon import compile_words
    rnd = random.Random(1)
    for size in (0, 1, 5, 60, 400):
        words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))).encode() for _ in range(size)})
        suffixes = {}                               # brute force: one state per distinct set of word ends
        for prefix in {w[:i] for w in words for i in range(len(w) + 1)} | {b""}:
            suffixes[prefix] = frozenset(w[len(prefix):] for w in words if w.startswith(prefix))
        assert len(compile_words(words)["final"]) == len(set(suffixes.values()))
        lex = lexicon_of(words, tmp_path)
        asked = words + [b"abcabcabcabc", b"zz", b"c" * 9, b""] + [w[:-1] for w in words]
        got = lex.numbers(np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked], np.int64))
        assert got.tolist() == [words.index(w) if w in words else -1 for w in asked]


def test_merges_equal_library():
    from tokenizers import Tokenizer

    from spark_ledger.llm.lexicon import Merges
    rnd, lib, merges = random.Random(2), Tokenizer.from_file(PATH), Merges(PATH)
    words = ["".join(rnd.choice("aeiouthnsrlé") for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    words += ["a" * n for n in range(1, 140)] + ["abc" * 60, "the" * 2000]
    raw = [w.encode() for w in words]
    flat, lens = merges.encode(np.frombuffer(b"".join(raw), np.uint8), np.array([len(w) for w in raw], np.int64))
    want = [e.ids for e in lib.encode_batch(words, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(flat, np.cumsum(lens)[:-1])] == want


@pytest.mark.parametrize("bound", [0, 40, 100_000])
def test_op12_equals_library(spark, bound):
    from tokenizers import Tokenizer

    from spark_ledger.llm.lexicon import digests, encode_decode, fit
    some = [None, *texts(600, 3)]
    rows = [(i if i else None, t, "clash", 1) for i, t in enumerate(some)] + [(7, some[7], "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, id int").repartition(3)
    got = digests(encode_decode(docs, PATH, fit(docs, PATH, bound))).collect()
    lib, by_id = Tokenizer.from_file(PATH), {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and sum(r["doc_id"] == 7 for r in got) == 2
    for i, t in enumerate(some):
        ids, r = lib.encode(t or "", add_special_tokens=False).ids, by_id[i or None]
        assert r["n_tokens"] == len(ids), (i, t)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), (i, t)
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    from spark_ledger.llm.lexicon import encode_decode, fit
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode_decode(docs, PATH, fit(docs, PATH)).count() == 0
