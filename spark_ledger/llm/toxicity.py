"""Toxicity by nearest labelled examples: exact weighted TF-IDF cosine over the
whole texts, and distance-weighted votes.

Terms are words and beginnings of words (``PREFIXES`` letters, marked ``*``), so
inflected and compounded forms count together.  Examples are a bounded sample of the labelled rows (``max_examples``, the first
by hash of their id; equal texts count once).  Every term of every example is in
the index; document frequencies come from the whole corpus.  A term's TF-IDF
weight is multiplied by how far its odds differ between the classes of the
examples (``relevance``), which does not depend on how frequent it is, so a rare
language's insult weighs as much as a frequent one and the topic of a long text
does not drown it.  Cosines are summed over postings; terms that weigh little for the
postings they have are summed only for examples that a bound leaves (Cauchy-Schwarz on
the norms of these weights), so the ``k`` nearest are exact; ties go to the smaller
example id.

Score: the votes of the neighbours weighted by cosine, with the examples' share
of toxic rows as ``prior_weight`` further votes.  Texts with no term of any
example (null and empty ones too) meet the examples that have none either: their
share of toxic rows.  Without examples of both classes every score is 0.5 or that
class's share.  Repeated rows give repeated results; an empty table an empty result.
"""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import cut_lineage

_WORD = re.compile(r"[^\W\d_]+")
PART = 1 << 14             # terms whose counts travel as one row


PREFIXES = (3, 4, 5, 6, 7)
OFTEN = (2, 4)             # a term counts again, as ``term>=n``, where it occurs so often
#: of single-byte characters the same ones, others as spaces
_LATIN = bytes(i if _WORD.match(chr(i)) else 32 for i in range(256))


def words_of(texts: list[str]) -> list[str]:
    """The words of lower-cased texts, a null character behind each text's."""
    out: list[str] = []
    for text in texts:
        text = text.lower()
        try:
            out += text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
        except UnicodeEncodeError:
            out += _WORD.findall(text)
        out.append("\0")
    return out


def terms_of(text: str) -> dict[str, int]:
    """All terms of a text with their occurrences."""
    out: dict[str, int] = {}
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for t in [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]:
            out[t] = out.get(t, 0) + n
    return out | {f"{t}>={k}": 1 for t, n in out.items() for k in OFTEN if n >= k}


class WordTerms:
    """Numbers of the terms of texts' words."""

    def __init__(self, terms: list[str]):
        parts = [t.partition(">=") for t in terms]
        plain = pa.array([p for p, *_ in parts], pa.string()).dictionary_encode()
        at, often = plain.indices.to_numpy(), np.array([int(k or 1) for *_, k in parts], np.int32)
        self.n_plain = len(plain.dictionary)
        # number of the term for a plain term that occurs once, and so often; -1: none
        self.term = {k: np.full(self.n_plain, -1, np.int32) for k in (1, *OFTEN)}
        for k, of in self.term.items():
            of[at[often == k]] = np.flatnonzero(often == k)
        # plain terms and their numbers: words (0) and beginnings by their length
        names, kind = plain.dictionary.to_pylist(), {}
        for i, p in enumerate(names):
            kind.setdefault(len(p) - 1 if p.endswith("*") else 0, []).append(i)
        self.known = {k: (pa.array([names[i].removesuffix("*") for i in of], pa.string()), np.array(of + [-1], np.int32))
                      for k, of in kind.items()}

    def numbers(self, words: pa.Array) -> np.ndarray:
        """A row of each word's numbers of plain terms, -1 where it has none."""
        out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int32)
        size = pc.utf8_length(words).to_numpy()
        for i, k in enumerate((0, *PREFIXES)):
            if k in self.known:
                names, number = self.known[k]
                at = np.flatnonzero(size > k)
                some = words.take(pa.array(at))
                some = pc.utf8_slice_codeunits(some, 0, k) if k else some
                out[at, i] = number[pc.index_in(some, value_set=names).fill_null(-1).to_numpy()]
        return out

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the text's terms, ascending, and their occurrences."""
        return self.counts_many([text])[0]

    def pairs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts' positions, numbers of their terms and occurrences, in no certain order:
        each distinct word is looked up once and (text, term) pairs are summed by one
        sort of plain numbers, occurrences in their lowest bits."""
        parts = pa.array(words_of(texts), pa.string()).dictionary_encode()
        code, words = parts.indices.to_numpy().astype(np.int64), parts.dictionary
        cut = code == words.index("\0").as_py()
        text, bits = np.cumsum(cut)[~cut], len(words).bit_length()
        pair, n = np.unique(text << bits | code[~cut], return_counts=True)
        text, code = pair >> bits, pair & (1 << bits) - 1
        got = self.numbers(words)
        size, flat = (got >= 0).sum(axis=1), got[got >= 0].astype(np.int64)
        at = _spans((np.cumsum(size) - size)[code], size[code])
        bits, low = self.n_plain.bit_length(), int(n.max(initial=0)).bit_length()
        key = np.sort((np.repeat(text << bits, size[code]) | flat[at]) << low | np.repeat(n, size[code]))
        n, key = key & (1 << low) - 1, key >> low
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.add.reduceat(n, first) if len(first) else n
        text, at = key[first] >> bits, key[first] & (1 << bits) - 1
        more = [np.flatnonzero(n >= k) for k in OFTEN]
        t = np.concatenate([self.term[1][at], *(self.term[k][at[m]] for k, m in zip(OFTEN, more, strict=True))])
        text = np.concatenate([text, *(text[m] for m in more)])
        n = np.concatenate([n, np.ones(len(t) - len(n), np.int64)])
        keep = t >= 0
        return text[keep], t[keep], n[keep]

    def counts_many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``counts`` of many texts at once."""
        if not texts:
            return []
        text, t, n = self.pairs(texts)
        bits, low = int(t.max(initial=0)).bit_length(), int(n.max(initial=0)).bit_length()
        key = np.sort((text << bits | t) << low | n)
        n, key = (key & (1 << low) - 1).astype(float), key >> low
        t, cuts = key & (1 << bits) - 1, np.searchsorted(key >> bits, np.arange(1, len(texts)))
        return list(zip(np.split(t, cuts), np.split(n, cuts), strict=True))


def portions(texts: list[str], rows: int = 1024, size: int = 1 << 21) -> Iterator[list[str]]:
    """The texts in order, so many at a time, or fewer of long ones."""
    some, held = [], 0
    for t in texts:
        if some and (len(some) == rows or held + len(t) > size):
            yield some
            some, held = [], 0
        some.append(t)
        held += len(t)
    if some:
        yield some


def weighted(t: np.ndarray, n: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and unit-length weights."""
    w = (1 + np.log(n)) * weights[t]
    norm = math.sqrt(float(w @ w))
    return (t, w / norm) if norm else (t[:0], w[:0])


def vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of a dictionary."""
    t = np.array(sorted(counts), np.int64)
    return weighted(t, np.array([counts[i] for i in t.tolist()], float), idf)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all spans, one after the other."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


class BlockMaxIndex:
    """Exact nearest unit vectors.  Light terms, those of least weight for the postings that
    queries would read (``LIGHT`` of the squared weights), are left out at first: the norms
    of an example's light weights, in ``BANDS`` of terms, bound what they can add, so
    they are summed only for examples that may be among the nearest.
    (The name is older: whole texts share so many terms that bounds of blocks prune none.)"""

    LIGHT = 0.01
    BANDS = 8

    def __init__(self, vectors: Iterable[tuple[np.ndarray, np.ndarray]], n_terms: int):
        """The vectors are read once, one by one, so no second copy of them is held."""
        self.n_terms, ends, t, w = n_terms, [0], array("i"), array("d")
        for terms, weights in vectors:
            t.frombytes(terms.astype(np.int32).tobytes())
            w.frombytes(weights.astype(float).tobytes())
            ends.append(len(t))
        self.n, self.start = len(ends) - 1, np.array(ends, np.int64)
        self.t, self.w = np.frombuffer(t, np.int32), np.frombuffer(w, float)

        held, energy = np.bincount(self.t, minlength=n_terms), np.zeros(n_terms)
        for e in range(self.n):
            energy[self.t[ends[e]:ends[e + 1]]] += self.w[ends[e]:ends[e + 1]] ** 2
        rank = np.flatnonzero(held)
        rank = rank[np.argsort(energy[rank] / held[rank] ** 2.0, kind="stable")]
        share = np.cumsum(energy[rank]) / max(float(energy.sum()), 1e-300) / self.LIGHT
        # light terms have the first numbers, so their weights in a query lie together
        self.band = (share[share < 1] * self.BANDS).astype(np.int8)
        order = np.argsort(held == 0, kind="stable")
        order[:len(rank)] = rank
        self.number = np.empty(n_terms, np.int32)
        self.number[order] = np.arange(n_terms)
        held = held[order]
        self.size, self.first = held.astype(np.int32), np.cumsum(held) - held
        # only to find candidates, so single precision does
        self.post, self.post_w = np.zeros(len(self.t), np.int32), np.zeros(len(self.t), np.float32)
        self.few, self.norms = np.zeros(self.n, np.int64), np.zeros((self.n, self.BANDS))
        free = self.first.copy()                           # next place of each term
        for e in range(self.n):
            terms, weights = self.t[ends[e]:ends[e + 1]], self.w[ends[e]:ends[e + 1]]
            number = self.number[terms]
            order = np.argsort(number >= len(self.band), kind="stable")       # light terms stand first
            terms[:], weights[:] = number[order], weights[order]
            self.post[free[terms]], self.post_w[free[terms]] = e, weights
            free[terms] += 1
            self.few[e] = few = int((terms < len(self.band)).sum())
            self.norms[e] = np.sqrt(np.bincount(self.band[terms[:few]], weights[:few] ** 2, self.BANDS))
        self.query = np.zeros(n_terms)

    def many(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """Of each vector the ``k`` examples of largest positive cosine as ``(cosine, example)``."""
        return [self.nearest(t, w, k) for t, w in vectors]

    def _add(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the terms' postings add to each example's cosine."""
        size = self.size[t]
        at = _spans(self.first[t], size)
        return np.bincount(self.post.take(at), self.post_w.take(at) * np.repeat(w, size), self.n)

    def _sums(self, some: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What the first terms of some examples add to their cosines."""
        if not len(some):
            return np.zeros(0)
        first = self.start[some]
        spans = list(map(slice, first.tolist(), (first + size).tolist()))
        both = self.query.take(np.concatenate([self.t[s] for s in spans])) * np.concatenate([self.w[s] for s in spans])
        return np.bincount(np.repeat(np.arange(len(some)), size), both, len(some))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        if not self.n:
            return []
        terms = self.number[terms]
        self.query[terms] = weights
        light = terms < len(self.band)
        near = self._add(terms[~light], weights[~light])
        norm = np.sqrt(np.bincount(self.band[terms[light]], weights[light] ** 2, self.BANDS))
        some = np.argpartition(near, self.n - k)[self.n - k:] if self.n > k else np.arange(self.n)
        cosine = near[some] + self._sums(some, self.few[some])
        # the k-th nearest is as near at least; single precision is off by 6e-8 at most
        least = max(float(cosine.min()) - 2e-7, 0.0) if self.n > k else 0.0
        bound = near + self.norms @ norm + 1e-7
        bound[some] = -1
        rest = np.flatnonzero(bound >= least)
        if int(self.few[rest].sum()) > int(self.size[terms[light]].sum()):
            near = near + self._add(terms[light], weights[light])
            more = near[rest]
        else:
            more = near[rest] + self._sums(rest, self.few[rest])
        some, cosine = np.concatenate([some, rest]), np.concatenate([cosine, more])
        if len(some) > k:
            some = some[cosine >= np.partition(cosine, len(some) - k)[len(some) - k] - 2e-7]
        some = np.sort(some)
        found = zip(self._sums(some, self.start[some + 1] - self.start[some]).tolist(), some.tolist())
        self.query[terms] = 0
        return sorted(((round(c, 12), e) for c, e in found if round(c, 12) > 0), key=lambda x: (-x[0], x[1]))[:k]


def pack(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def unpack(z: bytes, size: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(z, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


class Terms:
    """A list of terms, small to send."""

    def __init__(self, terms: list[str]):
        text = "\n".join(terms).encode()
        self.packed = pa.compress(text, codec="zstd", asbytes=True), len(text)

    def list(self) -> list[str]:
        text = pa.decompress(*self.packed, codec="zstd", asbytes=True).decode()
        return text.split("\n") if text else []

    def table(self) -> WordTerms:
        return _table(*self.packed)


@functools.lru_cache(maxsize=1)
def _table(packed: bytes, size: int) -> WordTerms:
    """Made once per Python worker."""
    out = Terms([])
    out.packed = packed, size
    return WordTerms(out.list())


class Model:
    """Terms, weights and the examples' counts, packed to be sent to every task;
    index and table of words are made from them where they are first used."""

    def __init__(self, terms: Terms, weights: np.ndarray, examples: list[tuple[np.ndarray, np.ndarray, int]], k: int,
                 prior_weight: float):
        self.words, self.weights, self.k, self.m = terms, weights, k, prior_weight
        self.y = [y for *_, y in examples]
        self.packed = [(len(t), pack(np.diff(t, prepend=0).astype(np.int32)), pack(n.astype(np.int32))) for t, n, _ in examples]
        self.prior = sum(self.y) / len(self.y) if self.y else 0.5
        self.opened = None

    def __getstate__(self):
        return self.__dict__ | {"opened": None}

    @property
    def terms(self) -> list[str]:
        return self.words.list()

    def _open(self):
        if self.opened is None:
            labels, bare = array("d"), []

            def vectors():
                for y, (size, t, n) in zip(self.y, self.packed, strict=True):
                    v = weighted(np.cumsum(unpack(t, size, np.int32), dtype=np.int32), unpack(n, size, np.int32), self.weights) if size else None
                    if v and len(v[0]):
                        labels.append(y)
                        yield v
                    else:
                        bare.append(y)

            index = BlockMaxIndex(vectors(), len(self.weights))
            self.opened = index, np.array(labels), (sum(bare) + self.m * self.prior) / (len(bare) + self.m) if self.y else 0.5
        return self.opened

    def scores(self, texts: list[str]) -> list[float]:
        return [s for s, _ in self.evidences(texts)]

    def evidence(self, text: str) -> tuple[float, list[tuple[float, int]]]:
        """Score and the neighbours that gave it."""
        return self.evidences([text])[0]

    def evidences(self, texts: list[str]) -> list[tuple[float, list[tuple[float, int]]]]:
        index, labels, bare = self._open()
        table = self.words.table()
        vectors = [weighted(*c, self.weights) for c in table.counts_many(texts)]
        out = []
        for (t, _), near in zip(vectors, index.many(vectors, self.k)):
            weight = sum(s for s, _ in near)
            votes = sum(s * labels[e] for s, e in near)
            out.append((float((votes + self.m * self.prior) / (weight + self.m)) if len(t) else bare, near))
        return out


def _emit(docs: DataFrame, make, kind: str, *keep: str) -> DataFrame:
    """``keep, has``: for each text the list that the function made by ``make``
    gives (made once per task)."""
    at = len(keep)
    src = docs.select(*keep, "text")
    schema = src.drop("text").withColumn("has", F.array().cast(f"array<{kind}>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                some = batch.slice(first, 500)
                has = [of(t.as_py() or "") for t in some.column(at)]
                yield pa.RecordBatch.from_arrays([*some.columns[:at], pa.array(has, pa.list_(
                    pa.int32() if kind == "int" else pa.string()))], [*keep, "has"])

    return src.mapInArrow(run, schema)


def corpus_counts(docs: DataFrame, sent, n_terms: int) -> np.ndarray:
    """Documents that hold each term, and last the number of documents.  Tasks send
    their sums as ``PART`` numbers a row, which are added up by part."""
    schema = "part int, n binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = sent.value.table(), np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for some in portions([t or "" for t in batch.column(0).to_pylist()]):
                n[:n_terms] += np.bincount(words.pairs(some)[1], minlength=n_terms)
            n[n_terms] += batch.num_rows
        rows = [(i, n[i * PART:(i + 1) * PART]) for i in range(n_terms // PART + 1)] if n[n_terms] else []
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()),
                                          pa.array([x.tobytes() for _, x in rows], pa.binary())], ["part", "n"])

    def add(table: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(x.as_py(), np.int64) for x in table["n"])
        return pa.table({"part": table["part"][:1], "n": pa.array([n.tobytes()], pa.binary())})

    out = np.zeros(n_terms + 1, np.int64)
    for r in docs.select("text").mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect():    # the terms / PART
        out[r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["n"], np.int64)
    return out


def relevance(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How far the odds of a term differ between the classes (log)."""
    return np.abs(np.log((a + .5) / (n1 + 1)) - np.log((b + .5) / (n0 + 1)))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 8000, k: int = 15, prior_weight: float = 0.5) -> Model:
    """``labels`` has ``doc_id, toxic`` (0/1) and only rows to learn from."""
    some = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples).withColumnRenamed("doc_id", "_id"))
    # at most max_examples ids; equal texts are one example, toxic if any is
    examples = cut_lineage(docs.join(F.broadcast(some), F.col("doc_id") == F.col("_id"))
                           .groupBy(F.coalesce("text", F.lit("")).alias("text"))
                           .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    none = np.zeros(0, np.int64)
    # what is collected below grows with the examples' texts, not with the corpus
    per = (_emit(examples, lambda: lambda text: list(terms_of(text)), "string", "toxic")
           .select("toxic", F.explode("has").alias("term")).groupBy("term")
           .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))).toArrow().sort_by("term") if n1 and n0 else None
    if per is None or not per.num_rows:
        return Model(Terms([]), np.zeros(0), [(none, none, y) for y, n in sizes.items() for _ in range(n)], k, prior_weight)
    terms = Terms(per["term"].to_pylist())
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    df = corpus_counts(docs, sent, per.num_rows)
    weights = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * relevance(per["a"].to_numpy(), per["b"].to_numpy(), n1, n0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value.table()
        for batch in batches:
            got = [x for some in portions(batch.column(2).to_pylist()) for x in words.counts_many(some)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([t.astype(np.int32).tobytes() for t, _ in got], pa.binary()),
                 pa.array([n.astype(np.int32).tobytes() for _, n in got], pa.binary())], ["doc_id", "toxic", "t", "n"])

    src = examples.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text")
    rows = src.mapInArrow(run, "doc_id long, toxic int, t binary, n binary").toArrow().sort_by("doc_id")
    held = [(np.frombuffer(t.as_py(), np.int32), np.frombuffer(n.as_py(), np.int32), y.as_py())
            for t, n, y in zip(rows["t"], rows["n"], rows["toxic"])]
    return Model(terms, weights, held, k, prior_weight)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)       # the terms of max_examples texts at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            got = [x for some in portions([t or "" for t in batch.column(1).to_pylist()]) for x in model.scores(some)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
