"""Substring dedup by level-wise doubling.

A window of ``length`` words is kept only if its words start in no document with
a smaller id.  Candidates come level by level: short windows first; those that
repeat in another document alone are extended to windows of twice the length,
until the full length is reached or no candidates survive.

The first level, half the full length, need not hold every position: in each run
of half windows that one full window covers, the one of least hash is its anchor.
The choice looks at the words alone, so documents that share a full window share
its anchor, and about one position in fourteen is shuffled.  Full windows whose
anchor repeats are then compared: they travel with their anchor's hash (64 bits)
and 32 bits of their own, a run of windows in one row.  Each task first compares
its own windows, so that a passage that very many documents share is sent once per
task; anchors with more than ``HOT`` places (a common line in ever new
surroundings) send their windows one by one, dealt by the window.

Tables between levels are written to the shared folder.  Null text has no words;
texts shorter than the window lose nothing; rows that share an id never remove
each other's words, see ``repeated_windows`` for those with different texts and for
rows without an id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import cut_lineage, shared_path
from spark_ledger.llm.words import WordHashes, mix, windows


#: places of an anchor above which its windows are dealt one by one
HOT = 1000
#: windows that a task compares at a time
BATCH = 2_000_000


def anchors_of(h: np.ndarray, span: int) -> np.ndarray:
    """Positions of the least hash in each run of ``span`` (all ties)."""
    if len(h) < span:
        return np.zeros(0, np.int64)
    low, width = h, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(h) - span + 1], low[span - width:])
    # a position is chosen if it is the least of some run that holds it
    padded = np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)])
    high, width = padded, 1
    while 2 * width <= span:
        high = np.maximum(high[:-width], high[width:])
        width *= 2
    if width < span:
        high = np.maximum(high[:len(padded) - span + 1], high[span - width:])
    return np.flatnonzero(high == h)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(length: int, half: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().encode().split()
                if len(words) >= length:
                    h = windows(hashes.of(words), half)
                    at = anchors_of(h, length - half + 1)
                    out.append((np.full(len(at), doc), h[at], at))
            if out:
                doc, h, at = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(doc), _signed(h), pa.array(at.astype(np.int32))], ["doc_id", "h", "at"])
    return run


def _runs(doc: np.ndarray, at: np.ndarray, key: np.ndarray, w: np.ndarray | None) -> pa.RecordBatch:
    """Rows of consecutive windows of one document (and, with ``w``, one key)."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    if w is not None:
        key, w = key[order], w[order].astype("<u4")
        new |= key[1:] != key[:-1]
    first = np.flatnonzero(np.concatenate([[True], new])) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(doc))
    raw = pa.py_buffer(w.tobytes()) if w is not None else pa.py_buffer(b"")
    offsets = np.append(first, len(doc)) * 4 if w is not None else np.zeros(len(first) + 1)
    keys = _signed(key[first]) if w is not None else pa.nulls(len(first), pa.int64())
    return pa.RecordBatch.from_arrays([
        keys, pa.array(doc[first]), pa.array(at[first].astype(np.int32)), pa.array((ends - first).astype(np.int32)),
        pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), raw])],
        ["key", "doc_id", "at", "n", "w"])


_RUNS = "key long, doc_id long, at int, n int, w binary"


def _repeats(key: np.ndarray, w: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows also start in a document of smaller id among these."""
    order = np.lexsort((doc, w, key))
    k, x, d = key[order], w[order], doc[order]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])])
    least = d[np.maximum.accumulate(np.where(first, np.arange(len(d)), 0))]
    out = np.zeros(len(d), bool)
    out[order] = d > least
    return out


def _window_rows(length: int, half: int):
    """Full windows whose anchor repeats: runs without a key are to be removed,
    runs with a key are still to be compared with those of other tasks."""
    span = length - half + 1

    def compared(held):
        key, w, doc, at = (np.concatenate(x) for x in zip(*held))
        gone = _repeats(key, w, doc)
        yield _runs(doc[gone], at[gone], key, None)
        yield _runs(doc[~gone], at[~gone], key[~gone], w[~gone])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, total = WordHashes(), [], 0
        for batch in batches:
            for doc, text, at, hot in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in (1, 2, 3))):
                h = hashes.of(text.as_py().encode().split())
                if len(h) < length:
                    continue
                hs, full = windows(h, half), windows(h, length)
                alive = np.zeros(len(hs), np.int8)
                for places, mark in ((at, 1), (hot, 2)):       # rows that share an id may be of other lengths
                    places = places.values.to_numpy()
                    alive[places[places < len(hs)]] = mark
                anchor = np.lib.stride_tricks.sliding_window_view(hs, span).argmin(axis=1) + np.arange(len(full))
                where = np.flatnonzero(alive[anchor] > 0)
                anchor = anchor[where]
                w = full[where]
                key = np.where(alive[anchor] == 2, mix(hs[anchor] ^ w), hs[anchor])
                held.append((key, (w >> np.uint64(32)).astype(np.uint32), np.full(len(where), doc), where))
                total += len(where)
                if total >= BATCH:
                    yield from compared(held)
                    held, total = [], 0
        if held:
            yield from compared(held)
    return run


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: windows to be removed, key by key."""
    def removed(table: pa.Table) -> pa.RecordBatch:
        n = table.column("n").to_numpy()
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        key, doc, at = (np.repeat(table.column(c).to_numpy(), n) for c in ("key", "doc_id", "at"))
        w = np.frombuffer(b"".join(table.column("w").to_pylist()), "<u4")
        gone = _repeats(key, w, doc)
        return _runs(doc[gone], (at + within)[gone], key, None)

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        key = table.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0      # the last key may go on in the next batch
        if cut:
            yield removed(table.slice(0, cut))
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield removed(rest)


def _cut(length: int, untouched: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()
                left = words
                if runs.is_valid:
                    cover = np.zeros(len(words) + 1, np.int64)
                    runs = runs.values
                    at, n = runs.field("at").to_numpy(), runs.field("n").to_numpy()
                    fits = at + n - 1 + length <= len(words)       # rows that share an id may be of other lengths
                    at, n = at[fits], n[fits]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + n - 1 + length, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    left = [w for w, g in zip(words, gone.tolist()) if not g]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                whole = untouched and len(left) == len(words)
                kept.append(text.as_py() if whole else b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_words", "n_removed", "kept"])
    return run


def _base(docs: DataFrame) -> DataFrame:
    """Rows that can take part: an id is needed to be smaller or larger than another."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def repeated_windows(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, at, n``: runs of ``n`` windows from start word ``at`` that are to
    be removed.  Rows that share an id but not their text, and rows without an id,
    lose nothing; the former's windows still count for larger ids."""
    spark, half = docs.sparkSession, -(-length // 2)
    path = shared_path(spark, "anchors")
    _base(docs).mapInArrow(_anchor_rows(length, half), "doc_id long, h long, at int").write.parquet(path)
    anchors = spark.read.parquet(path)
    # written, so that the join stands on plain exchanges
    repeats = cut_lineage(anchors.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n"))
                          .where("x < y").select("h", (F.col("n") > HOT).alias("hot")))
    at = anchors.join(repeats, "h").groupBy("doc_id").agg(
        F.collect_list("at").alias("alive"), F.collect_list(F.when(F.col("hot"), F.col("at"))).alias("hot"))
    path = shared_path(spark, "windows")
    (_base(docs).join(at, "doc_id").select("doc_id", "text", "alive", "hot")
     .mapInArrow(_window_rows(length, half), _RUNS).write.parquet(path))
    runs = spark.read.schema(_RUNS).parquet(path)
    far = (runs.where("key is not null").repartition("key").sortWithinPartitions("key").mapInArrow(_compare_runs, _RUNS))
    # an id with different texts does not say whose words a run covers
    several = (_base(docs).groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("x"), F.max(F.xxhash64("text")).alias("y"), F.count("*").alias("c"))
               .where("c > 1 and x < y").select("doc_id"))
    return runs.where("key is null").unionByName(far).select("doc_id", "at", "n").join(several, "doc_id", "left_anti")


def without_windows(docs: DataFrame, runs: DataFrame, length: int = 50, untouched: bool = False) -> DataFrame:
    """The other columns of ``docs`` as struct ``row``, with ``n_words, n_removed,
    kept``: the text's words without those covered by the runs, joined by one
    space (``untouched``: texts that lose nothing stay as they are)."""
    per_doc = runs.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("_runs"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("_id"))
    joined = rows.join(per_doc.withColumnRenamed("doc_id", "_id"), "_id", "left").select("row", "text", "_runs")
    schema = joined.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                           F.col("text").alias("kept")).schema
    return joined.mapInArrow(_cut(length, untouched), schema)


def substring_dedup(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row."""
    cut = without_windows(docs.select("doc_id", "text"), repeated_windows(docs, length), length)
    return cut.select("row.doc_id", "n_words", "n_removed", "kept")
