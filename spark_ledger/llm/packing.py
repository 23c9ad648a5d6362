"""Best-fit decreasing packing with a segment tree over remaining capacities.

Best-fit decreasing only looks at lengths, and lengths are whole numbers up to
the sequence length.  So the packing is planned on the histogram of lengths (at
most ``capacity`` rows, whatever the corpus): the lengths come in decreasing
order, a segment tree over remaining capacities finds the tightest open bins in
logarithmic time, and equal bins take their pieces together.  This is exactly
what best-fit decreasing does one piece after the other.  The plan says, for
each range of ranks within a length, the first bin, the pieces a bin takes and
their offset; pieces are numbered within their length in hashed buckets, so no
task holds a whole length, and look their place up in the broadcast plan.

Null and empty texts are one end id; repeated rows are packed as documents of
their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_ledger.llm.chunks import ByteLevelEncoder, encoder, slices
from spark_ledger.llm.common import cut_lineage

PLAN_SCHEMA = "length int, rank_from long, rank_to long, first_bin long, per_bin int, at int"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, tokens`` (little-endian unsigned 32-bit
    ids) of every document: its ids and the end id, cut into pieces of
    ``capacity`` ids of which the first may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ByteLevelEncoder, tokenizer_path)
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for first, n in slices(texts):
                flat, counts = enc.encode(texts.slice(first, n))
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, end_id).astype("<u4")
                counts = counts + 1
                pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = counts - (pieces - 1) * capacity
                length = np.where(piece == 0, head[doc], capacity)
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                raw = pa.py_buffer(flat.tobytes())
                offsets = pa.py_buffer((np.concatenate([[0], np.cumsum(length)]) * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)),
                    pa.Array.from_buffers(pa.binary(), len(doc), [None, offsets, raw])],
                    ["doc_id", "piece", "start", "length", "tokens"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, tokens binary")


class CapacityTree:
    """Segment tree over capacities: the smallest one at or above a length that
    has open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.open = [0] * (2 * self.size)

    def set(self, capacity: int, n: int) -> None:
        i = self.size + capacity
        self.open[i] = n
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] + self.open[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        i = self.size + length
        if self.open[i]:
            return length
        while i > 1:                                   # up to where bins stand on the right
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan(histogram: list[tuple[int, int]], capacity: int) -> list[tuple]:
    """Best-fit decreasing over ``(length, count)``; rows of ``PLAN_SCHEMA``.

    Bins are numbered from 0 and kept as runs of equal remaining capacity
    ``(first bin, number)``; a run is split where only a part of it takes
    pieces, so the plan has a few rows per length at most."""
    tree, runs = CapacityTree(capacity), [deque() for _ in range(capacity + 1)]
    opened, rows = [0] * (capacity + 1), []

    def put(room: int, first: int, n: int) -> None:
        if n:
            runs[room].append((first, n))
            opened[room] += n
            tree.set(room, opened[room])

    bins = 0
    for length, count in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        rank = 0
        while rank < count:
            room = tree.tightest(length)
            left = count - rank
            if room is None:
                room, per = capacity, capacity // length
                first, n = bins, -(-left // per)
                bins += n
            else:
                per = room // length
                first, n = runs[room].popleft()
                opened[room] -= n
                used = min(n, -(-left // per))
                put(room, first + used, n - used)
                tree.set(room, opened[room])
                n = used
            whole = min(n, left // per)                # bins that take ``per`` pieces
            rest = min(left - whole * per, (n - whole) * per)
            rows.append((length, rank, rank + whole * per + rest, first, per, capacity - room))
            put(room - per * length, first, whole)
            put(room - rest * length, first + whole, n - whole)
            rank += whole * per + rest
    return rows


def pack(pieces: DataFrame, capacity: int, buckets: int = 256) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` column.

    ``pieces`` must be a written table (its rows are numbered, so they must not
    change between passes)."""
    spark = pieces.sparkSession
    keyed = pieces.withColumn("_b", F.pmod(F.xxhash64(*[c for c in pieces.columns]), F.lit(buckets)).cast("int"))
    counts = keyed.groupBy("length", "_b").count()
    # at most capacity x buckets rows, independent of the corpus
    before = counts.withColumn("_before", F.sum("count").over(
        Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "_b", F.coalesce("_before", F.lit(0)).alias("_before"))
    order = [c for c in pieces.columns]
    ranked = (keyed.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_b").orderBy(*order)))
              .join(before, ["length", "_b"])
              .withColumn("_rank", F.col("_before") + F.col("_r") - 1))
    histogram = [(int(r["length"]), int(r["n"])) for r in
                 counts.groupBy("length").agg(F.sum("count").alias("n")).collect()]
    table = spark.createDataFrame(plan(histogram, capacity), PLAN_SCHEMA)
    # a few rows per length: bounded by the capacity, so it is broadcast
    return (ranked.join(F.broadcast(table.withColumnRenamed("length", "_l")),
                        (F.col("length") == F.col("_l")) & (F.col("_rank") >= F.col("rank_from"))
                        & (F.col("_rank") < F.col("rank_to")))
            .withColumn("_k", F.col("_rank") - F.col("rank_from"))
            .withColumn("sequence_id", F.col("first_bin") + F.expr("_k div per_bin"))
            .withColumn("offset", F.col("at") + (F.col("_k") % F.col("per_bin")) * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its place; the pieces' ids are kept as
    a checksum (``ids_crc32``), the ids themselves come from ``token_pieces``."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id).select(
        "doc_id", "piece", "start", "length", F.crc32("tokens").alias("ids_crc32"))
    return pack(cut_lineage(pieces), capacity)


def sequences(placed: DataFrame, tokens: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, tokens`` (binary), joined
    from the places and ``token_pieces`` of the same documents.  Documents must
    have distinct ids."""
    return (placed.select("doc_id", "piece", "sequence_id", "offset")
            .join(tokens.select("doc_id", "piece", "tokens"), ["doc_id", "piece"])
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "tokens"))).alias("parts"))
            .select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> a || p.tokens)").alias("tokens")))
