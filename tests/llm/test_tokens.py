"""Encoders, packing and token files against the libraries and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
path = public_tokenizers.path

PIECES = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", ",", "'", "'s", "12", "日本", "▁", "　", "́", "$",
          "don't ", "The ", "word ", "<|endoftext|>", "😀", "\r\n", "   ", "—", " x", "LL", "\0"]


def texts(n, seed=0):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 20))) for _ in range(n)] + ["", " ", "  ", "x " * 3000]


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("kind,name", [("ByteLevelEncoder", "byte_bpe_50k.json"), ("WordEndEncoder", "word_bpe_49k.json")])
def test_chunk_tables_equal_library(kind, name):
    from tokenizers import Tokenizer

    from spark_ledger.llm import chunks
    enc, lib = getattr(chunks, kind)(path(name)), Tokenizer.from_file(path(name))
    for seed in (1, 2):                                # the second pass meets a filled table
        some = texts(3000, seed)
        want = [e.ids for e in lib.encode_batch(some, add_special_tokens=False)]
        assert split(*enc.encode(pa.array(some))) == want


def test_table_is_emptied(monkeypatch):
    from spark_ledger.llm import chunks
    monkeypatch.setattr(chunks, "MAX_ENTRIES", 50)
    enc = chunks.WordEndEncoder(path("word_bpe_49k.json"))
    first = enc.encode(pa.array(["".join(f"w{i} " for i in range(200))]))[0].tolist()
    assert enc.store.full()
    assert enc.encode(pa.array(["".join(f"w{i} " for i in range(200))]))[0].tolist() == first


def test_op5_equals_library(spark):
    import sentencepiece

    from spark_ledger.llm.sentencepiece_op import digests, encode_decode
    some = [None, *texts(800, 3)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(some)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in digests(encode_decode(docs, path("piece_bpe_32k.model"))).collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for i, t in enumerate(some):
        ids = lib.encode(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert encode_decode(empty, path("piece_bpe_32k.model")).count() == 0


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    from spark_ledger.llm.packing import plan
    rnd = random.Random(4)
    for _ in range(60):
        cap = rnd.choice([7, 20, 64])
        lengths = [rnd.randint(1, cap) if rnd.random() < .8 else 3 for _ in range(rnd.randint(0, 120))]
        rows = plan([(n, lengths.count(n)) for n in set(lengths)], cap)
        used = {}
        for n, lo, hi, first, per, at in rows:
            for k in range(hi - lo):
                used.setdefault(first + k // per, []).append((at + k % per * n, n))
        for spans in used.values():
            spans.sort()
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sorted(cap - sum(n for _, n in s) for s in used.values()) == best_fit(lengths, cap)
        assert sorted(n for s in used.values() for _, n in s) == sorted(lengths)


def test_op8_places_every_token(spark):
    from tokenizers import Tokenizer

    from spark_ledger.llm.packing import pack_documents, sequences, token_pieces
    lib, some = Tokenizer.from_file(path("byte_bpe_50k.json")), [None, *texts(300, 5)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(some)], "doc_id long, text string, length int")
    placed = pack_documents(docs, path("byte_bpe_50k.json"), 256).cache()
    got, ids = {}, {i: lib.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(some)}
    for r in placed.orderBy("doc_id", "piece").collect():
        have = got.setdefault(r["doc_id"], [])
        assert r["start"] == sum(map(len, have)) and 0 < r["length"] <= 256 and (r["piece"] == 0 or r["length"] == 256)
        have.append(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(have[-1], "<u4").tobytes())
    assert {i: sum(p, []) for i, p in got.items()} == ids
    spans = {}
    for r in placed.collect():
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[-1][0] + s[-1][1] <= 256
    made = sequences(placed, token_pieces(docs, path("byte_bpe_50k.json"), 256)).collect()
    assert sum(len(r["tokens"]) for r in made) == 4 * sum(map(len, ids.values())) and len(made) == len(spans)
    assert pack_documents(docs.limit(0), path("byte_bpe_50k.json")).count() == 0


def test_dac_round_trip():
    from spark_ledger.llm.dac import Dac, dac_encode
    rnd = np.random.default_rng(6)
    for n in (0, 1, 7, 8, 511, 512, 513, 5000):
        ids = rnd.integers(0, rnd.choice([2, 200, 49408, 2**32]), n).astype(np.uint32)
        code = Dac(dac_encode(ids))
        assert len(code) == n and code.all().tolist() == ids.tolist()
        assert [code.get(i) for i in range(0, n, 7)] == ids[::7].tolist()


def test_op10_files(spark, tmp_path):
    from tokenizers import Tokenizer

    from spark_ledger.llm.dac import read_tokens, token_at, write_tokens
    lib, some = Tokenizer.from_file(path("word_bpe_49k.json")), [None, *texts(300, 7)]
    docs = spark.createDataFrame([(3 * i - 50, t, 1) for i, t in enumerate(some)], "doc_id long, text string, part int")
    write_tokens(docs, str(tmp_path / "t"), path("word_bpe_49k.json"), 2, shard_ids=500, partitions=3)
    got, at = read_tokens(spark, str(tmp_path / "t")).orderBy("doc_id").collect(), 0
    assert [r["doc_id"] for r in got] == [3 * i - 50 for i in range(len(some))]
    for r, t in zip(got, some, strict=True):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"]) == (at, len(ids)) and bytes(r["tokens"]) == np.array(ids, "<u4").tobytes()
        at += len(ids)
    assert token_at(spark.read.parquet(str(tmp_path / "t")), 0, 0, 0) == 2     # the null text
    rows = [(None, "b"), (2, "c"), (None, "b"), (2, "a"), (2, "a")]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "n"), path("word_bpe_49k.json"))
    got = read_tokens(spark, str(tmp_path / "n")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 2, 2, 2] and [r["start"] for r in got] == [0, 2, 4, 6, 8]
    write_tokens(docs.limit(0), str(tmp_path / "e"), path("word_bpe_49k.json"))
    assert read_tokens(spark, str(tmp_path / "e")).count() == 0
