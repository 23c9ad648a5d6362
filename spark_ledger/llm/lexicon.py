"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

``fit`` counts the words (pre-tokens) of the whole corpus in Spark, takes the
``max_words`` most frequent ones (a documented bound on the model, 131,072 by
default), merges each of them once and compiles them into a minimal acyclic
automaton: words share prefixes and suffixes, and the outputs along a word's
arcs add up to its number, which addresses its ids.  The arrays lie in one file
that Spark's file service hands to every executor (also to one that replaces a
lost one) and that Python workers memory-map, so workers of a machine share it.

``encode_decode`` cuts each text at white space, looks every distinct word of a
slice up by walking the automaton for all words at once, and merges the words
that are not in it exactly, by the ranks of the file's merges.  The lexicon
changes the work, never the ids.

Null text counts as empty; an empty text has no ids and decodes to the empty
string.  Null and repeated ids give a row each, an empty table an empty result,
and other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.chunks import byte_alphabet, slices
from spark_ledger.llm.common import cut_lineage

MAX_WORDS = 131_072        # words of the lexicon at most, the most frequent ones
SLICE_BYTES = 3_000_000    # text handled at a time
LONG_WORD = 96             # symbols from which a word is merged with a heap of its own
_NONE = np.int64(1) << 40  # rank of a pair that does not merge


def places(start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions of runs ``start .. start + lens`` one after the other."""
    ends = np.cumsum(lens)
    where = np.repeat(start - (ends - lens), lens)
    return where + np.arange(len(where))


class Merges:
    """The merges of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for char, byte in byte_alphabet().items():
            self.inner[byte], self.last[byte] = vocab[char], vocab[char + end]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.table = {int(k): (r, int(m)) for r, (k, m) in enumerate(zip(keys, made, strict=True))}

    def _long(self, sym: list[int]) -> list[int]:
        """One word by a heap of (rank, place) over a linked list."""
        n, size, table = len(sym), self.size, self.table
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*table[k], i, sym[i], sym[i + 1]) for i in range(n - 1) if (k := sym[i] * size + sym[i + 1]) in table]
        heap = [(r, i, m, a, b) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], after[i] = made, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (hit := table.get(sym[x] * size + sym[y])):
                    heapq.heappush(heap, (hit[0], x, hit[1], sym[x], sym[y]))
        return [s for s, ok in zip(sym, alive, strict=True) if ok]

    def encode(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as their bytes one after the other: in each round
        every word merges its pair of lowest rank, from left to right."""
        out, sizes = [], np.zeros(len(lens), np.int64)
        ends = np.cumsum(lens)
        sym = self.inner[data]
        sym[(ends - 1)[lens > 0]] = self.last[data[(ends - 1)[lens > 0]]]
        long = np.flatnonzero(lens > LONG_WORD)
        for w in long:
            ids = self._long(sym[ends[w] - lens[w]:ends[w]].tolist())
            out.append((w, np.array(ids, np.int64)))
            sizes[w] = len(ids)
        todo = np.flatnonzero((lens > 0) & (lens <= LONG_WORD))
        sym, n = sym[places((ends - lens)[todo], lens[todo])], lens[todo]
        done_ids, done_words = [], []
        while len(todo):
            cut = np.cumsum(n)
            rank, made = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
            if len(sym) > 1:
                key = sym[:-1] * self.size + sym[1:]
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                hit = self.keys[at] == key
                hit[cut[:-1] - 1] = False               # not across words
                rank[:-1][hit], made[:-1][hit] = self.rank[at[hit]], self.made[at[hit]]
            least = np.minimum.reduceat(rank, cut - n)
            over = least == _NONE
            if over.any():
                gone = np.repeat(over, n)
                done_ids.append(sym[gone])
                done_words.append((todo[over], n[over]))
                sym, rank, made = sym[~gone], rank[~gone], made[~gone]
                todo, n, least = todo[~over], n[~over], least[~over]
                if not len(todo):
                    break
            take = rank == np.repeat(least, n)
            first = take & ~np.concatenate([[False], take[:-1]])
            place = np.arange(len(take))
            run = place - np.maximum.accumulate(np.where(first, place, 0))
            take &= run % 2 == 0                        # a pair of equal symbols may overlap itself
            sym[take] = made[take]
            keep = ~np.concatenate([[False], take[:-1]])
            n = n - np.add.reduceat(take.astype(np.int64), np.cumsum(n) - n)
            sym = sym[keep]
        flat = np.concatenate([*done_ids, *(x for _, x in out), np.zeros(0, np.int64)])
        words = np.concatenate([*(w for w, _ in done_words), np.array([w for w, _ in out], np.int64)]).astype(np.int64)
        count = np.concatenate([*(c for _, c in done_words), np.array([len(x) for _, x in out], np.int64)]).astype(np.int64)
        sizes[words] = count
        start = np.zeros(len(lens), np.int64)
        start[words] = np.cumsum(count) - count
        return flat[places(start, sizes)], sizes


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted, distinct, non-empty words, built in
    one pass: a state that can no longer change is replaced by an equal one."""
    register: dict = {}
    finished: list[tuple] = []                      # state -> (final, ((label, target), ...))

    def finish(node):
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(finished)
            finished.append(key)
        return register[key]

    path = [[False, []]]                            # open states of the last word: [final, arcs]
    last = b""

    def close(depth):
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], finish(node)))

    for word in words:
        common = len(os.path.commonprefix([last, word]))
        close(common)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        last = word
    close(0)
    root = finish(path[0])
    count = []                                      # words from a state on; targets stand before their sources
    for final, arcs in finished:
        count.append(final + sum(count[t] for _, t in arcs))
    rows = []
    for state, (final, arcs) in enumerate(finished):
        number = int(final)
        for label, target in arcs:
            rows.append((state << 8 | label, target, number))
            number += count[target]
    if len(finished) >= 1 << 23:
        raise ValueError("the lexicon has too many states for 31-bit arcs")
    key, target, out = np.array(rows, np.int32).reshape(-1, 3).T
    order = np.argsort(key, kind="stable")
    return {"root": np.array([root, max(map(len, words), default=0)], np.int32), "key": key[order], "target": target[order],
            "out": out[order], "final": np.array([f for f, _ in finished], np.int32)}


_PARTS = ("root", "key", "target", "out", "final", "start", "ids")


class Lexicon:
    """A compiled lexicon in a memory-mapped file: sizes of its parts, then the
    parts, all 32-bit."""

    def __init__(self, path: str):
        flat = np.memmap(path, np.int32, mode="r")
        cuts = np.cumsum([len(_PARTS), *flat[:len(_PARTS)]])
        for name, lo, hi in zip(_PARTS, cuts, cuts[1:], strict=False):
            setattr(self, name, flat[lo:hi])

    @staticmethod
    def write(path: str, words: list[bytes], flat: np.ndarray, lens: np.ndarray) -> None:
        """Compile sorted words with their ids into a file."""
        parts = compile_words(words) | {"start": np.concatenate([[0], np.cumsum(lens)]), "ids": flat}
        arrays = [np.asarray(parts[p], np.int32) for p in _PARTS]
        np.concatenate([np.array([len(a) for a in arrays], np.int32), *arrays]).tofile(path)

    def numbers(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Number of each word (-1: not in the lexicon), all walked at once."""
        out = np.full(len(lens), -1, np.int64)
        at = np.flatnonzero((lens > 0) & (lens <= self.root[1]))
        begin = (np.cumsum(lens) - lens)[at]
        state, number, left = np.full(len(at), self.root[0], np.int32), np.zeros(len(at), np.int32), lens[at].copy()
        depth = 0
        while len(at):
            key = state << 8 | data[begin + depth]
            arc = np.searchsorted(self.key, key)
            arc[arc == len(self.key)] = 0
            hit = self.key[arc] == key
            at, begin, left, arc = at[hit], begin[hit], left[hit] - 1, arc[hit]
            state, number = self.target[arc], number[hit] + self.out[arc]
            over = left == 0
            ends = over & (self.final[state] == 1)
            out[at[ends]] = number[ends]
            at, begin, left, state, number = at[~over], begin[~over], left[~over], state[~over], number[~over]
            depth += 1
        return out


_SPACES = np.arange(256, dtype=np.uint8)
_SPACES[[9, 10, 11, 12, 13]] = 32


class WordCutter:
    """Texts -> distinct words.  White space never reaches a word, so a text is
    cut there first; each distinct chunk is cut into words once per slice."""

    _letters, _punct = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:-@\\[-`{-~"      # plain: lower case and normal form are one to one
    _plain = re.compile(f"[0-9{_letters}{_punct}]*").fullmatch
    _words = re.compile(f"[{_letters}]+|[0-9]|[{_punct}]+|\n").findall

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.lib = Tokenizer.from_file(path)
        self.special = [t["content"] for t in json.loads(self.lib.to_str())["added_tokens"]]
        self.bytes_of = byte_alphabet()

    def odd(self, chunk: str) -> list[str]:
        """Words of a chunk by the file's own normal form and cuts."""
        parts = self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(chunk))
        return [bytes(self.bytes_of[c] for c in p).decode() for p, _ in parts]

    def cut(self, texts: pa.Array):
        """``(offsets, codes, start, count, words, marked)``: chunk codes of the
        texts; the words of chunk ``c`` are ``words[start[c]:start[c] +
        count[c]]``; ``marked`` maps chunks with a special token to their text."""
        texts = texts.cast(pa.string())
        if texts.offset or not len(texts):
            texts = pa.concat_arrays([texts, pa.array([], pa.string())])
        _, offsets, data = texts.buffers()
        if data is not None:
            data = pa.py_buffer(_SPACES[np.frombuffer(data, np.uint8)])
            texts = pa.StringArray.from_buffers(len(texts), offsets, data)
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        odd = [i for i, c in enumerate(chunks) if not self._plain(c) or any(s in c for s in self.special)]
        marked = {i: chunks[i] for i in odd if any(s in chunks[i] for s in self.special)}
        rest = {i: [] if i in marked else self.odd(chunks[i]) for i in odd}
        for i in odd:
            chunks[i] = ""
        words = pa.array(self._words("\n".join(chunks).lower() + "\n"), pa.string())
        breaks = np.flatnonzero(pc.equal(words, "\n").to_numpy(zero_copy_only=False))
        count = np.diff(breaks, prepend=-1) - 1
        start = breaks - count
        extra = []
        for i in odd:
            start[i], count[i] = len(words) + len(extra), len(rest[i])
            extra += rest[i]
        words = pa.concat_arrays([words, pa.array(extra, pa.string())])
        return offsets - offsets[0], coded.indices.to_numpy().astype(np.int64), start, count, words, marked


def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        for batch in batches:
            texts = batch.column(0).cast(pa.string())
            for first, n in slices(texts, SLICE_BYTES):
                _, codes, start, count, words, _ = cutter.cut(texts.slice(first, n))
                weight = np.bincount(codes, minlength=len(start))
                coded = words.dictionary_encode()
                sums = np.bincount(coded.indices.to_numpy()[places(start, count)], np.repeat(weight, count), len(coded.dictionary))
                used = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(used)), pa.array(sums[used].astype(np.int64))], ["word", "n"])

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _layout(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words one after the other, and their lengths."""
    if words.offset or not len(words):
        words = pa.concat_arrays([words, pa.array([], pa.string())])
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, np.int32)[:len(words) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[cuts[0]:cuts[-1]] if len(cuts) else flat[:0], np.diff(cuts)


def fit(docs: DataFrame, path: str, max_words: int = MAX_WORDS) -> str:
    """Count, compile and ship the lexicon; returns the name of its file.

    Words are taken from a count on that keeps them within the bound; the count
    comes from a histogram of some hundred rows, so the driver sees no others."""
    counts = cut_lineage(word_counts(docs, path).withColumn("size", F.floor(F.log2("n") * 16).cast("int")))
    taken, least = 0, None
    for r in counts.groupBy("size").count().orderBy(F.desc("size")).collect():
        taken += r["count"]
        if taken > max_words:
            break
        least = r["size"]
    top = counts.where(F.col("size") >= F.lit(least)).select("word").collect()
    words = sorted(r["word"].encode() for r in top)
    flat, lens = Merges(path).encode(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))
    file = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), f"lexicon-{uuid.uuid4().hex}.bin")
    Lexicon.write(file, words, flat, lens)
    docs.sparkSession.sparkContext.addFile(file)    # from here Spark carries it to the executors
    return os.path.basename(file)


class Encoder:
    """Lexicon first, exact merges for the rest."""

    def __init__(self, path: str, lexicon: Lexicon):
        self.cutter, self.merges, self.lexicon = _cutter(path), Merges(path), lexicon
        self.first, self.known = np.asarray(lexicon.start, np.int64), np.asarray(lexicon.ids, np.int64)
        vocab = self.cutter.lib.get_vocab(with_added_tokens=True)
        raw = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            raw[i] = piece.encode() + b" "          # a file without decoder joins pieces by one space
        self.piece_len = np.fromiter(map(len, raw), np.int64, len(raw))
        self.piece_start = np.cumsum(self.piece_len) - self.piece_len
        self.piece = np.frombuffer(b"".join(raw), np.uint8)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, start, count)`` of distinct words."""
        data, lens = _layout(words)
        number = self.lexicon.numbers(data, lens)
        unseen = np.flatnonzero(number < 0)
        at = (np.cumsum(lens) - lens)[unseen]
        flat, sizes = self.merges.encode(data[places(at, lens[unseen])], lens[unseen])
        first, ids = self.first, np.concatenate([self.known, flat])
        start, count = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
        seen = np.flatnonzero(number >= 0)
        start[seen], count[seen] = first[number[seen]], np.diff(first)[number[seen]]
        start[unseen], count[unseen] = first[-1] + np.cumsum(sizes) - sizes, sizes
        return ids, start, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        offsets, codes, start, count, words, marked = self.cutter.cut(texts)
        coded = words.dictionary_encode()
        ids, id_start, id_count = self.words(coded.dictionary)
        of = coded.indices.to_numpy().astype(np.int64)[places(start, count)]     # words of chunk after chunk
        flat = ids[places(id_start[of], id_count[of])]
        chunk_ends = np.concatenate([[0], np.cumsum(id_count[of])])[np.cumsum(count)]
        chunk_lens = np.diff(chunk_ends, prepend=0)
        chunk_start = chunk_ends - chunk_lens
        for i, chunk in marked.items():             # the file's own rules say where special tokens stand
            got = np.array(self.cutter.lib.encode(chunk, add_special_tokens=False).ids, np.int64)
            chunk_start[i], chunk_lens[i] = len(flat), len(got)
            flat = np.concatenate([flat, got])
        lens = chunk_lens[codes]
        ends = np.concatenate([[0], np.cumsum(lens)])[offsets]
        return flat[places(chunk_start[codes], lens)], np.diff(ends)

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Pieces of each id list, joined by one space."""
        lens = self.piece_len[flat]
        ends = np.concatenate([[0], np.cumsum(lens)])
        data = self.piece[places(self.piece_start[flat], lens)]
        cuts = ends[np.concatenate([[0], np.cumsum(counts)])]
        joined = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
        return pc.binary_slice(joined.cast(pa.large_binary()), 0, -1).cast(pa.large_string())


_KEPT: dict = {}


def _cutter(path: str) -> WordCutter:
    if path not in _KEPT:
        _KEPT[path] = WordCutter(path)
    return _KEPT[path]


def _encoder(path: str, name: str) -> Encoder:
    if (path, name) not in _KEPT:
        _KEPT[path, name] = Encoder(path, Lexicon(SparkFiles.get(name)))
    return _KEPT[path, name]


def encode_decode(docs: DataFrame, path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded string)`` of every text, as the library
    encodes it without special tokens at its ends and decodes those ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, lexicon)
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for first, n in slices(texts, SLICE_BYTES):
                flat, counts = enc.encode(texts.slice(first, n))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))),
                    enc.decode(flat, counts).cast(pa.string())], ["id", "ids", "decoded"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids and the digests of the ids and the decoded text."""
    return coded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
