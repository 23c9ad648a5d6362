"""Token ids as directly addressable codes, written to files and read back.

Ids are split into chunks of ``WIDTH`` bits.  Level ``k`` holds the ``k``-th
chunk of every id that has one, in order, with a bitmap that says whether the id
goes on; a directory holds the rank (number of set bits) before every block of
``RANK_STEP`` bits.  So id number ``i`` is read by following its chunk from
level to level with one rank each: any token is reached without decoding a
block.

A file is a Parquet table of shards, each a self-contained code of a run of
whole documents in ascending ``doc_id`` order (repeated ids stay side by side, rows
without an id come first), so files are committed by Spark's writer, live in any store Spark reads, and a
lost executor's shard is written again.  Null and empty texts are one end id;
an empty table gives no shards.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_ledger.llm.chunks import WordEndEncoder, encoder, slices

WIDTH = 8                 # bits of a chunk
RANK_STEP = 512           # bits between entries of the rank directory
MAGIC = b"DAC1"


def dac_encode(ids: np.ndarray) -> bytes:
    """Code of unsigned 32-bit ids."""
    rest, levels = ids.astype(np.uint32), []
    while len(rest):
        more = rest >> WIDTH > 0
        bits = np.packbits(more, bitorder="little")
        steps = np.add.reduceat(np.unpackbits(bits, bitorder="little").astype(np.int64),
                                np.arange(0, len(more), RANK_STEP))
        ranks = (np.cumsum(steps) - steps).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes()
                      + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> WIDTH
    return MAGIC + struct.pack("<Q", len(levels)) + b"".join(levels)


class Dac:
    """A code, read in place."""

    def __init__(self, code: bytes):
        if code[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        n_levels, at, self.levels = struct.unpack_from("<Q", code, 4)[0], 12, []
        for _ in range(n_levels):
            n = struct.unpack_from("<Q", code, at)[0]
            chunks = np.frombuffer(code, np.uint8, n, at + 8)
            bits = np.frombuffer(code, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(code, "<u4", -(-n // RANK_STEP), at + 8 + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + len(bits) + ranks.nbytes

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    def get(self, i: int) -> int:
        """Id number ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = i // RANK_STEP * RANK_STEP
            full = bits[block // 8:byte].tobytes()
            i = int(ranks[i // RANK_STEP]) + int.from_bytes(full, "little").bit_count() \
                + (int(bits[byte]) & (1 << bit) - 1).bit_count()
            shift += WIDTH
        return value

    def all(self) -> np.ndarray:
        """Every id."""
        out, where = np.zeros(len(self), np.uint32), np.arange(len(self))
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks.astype(np.uint32) << np.uint32(WIDTH * k)
            where = where[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


SHARDS = "part int, shard int, before long, docs array<long>, lens array<long>, n_ids long, code binary"


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, shard_ids: int = 1 << 20,
                 partitions: int | None = None) -> None:
    """Encode all documents, the end id behind each, in ascending ``doc_id``
    order, and write them as shards of about ``shard_ids`` ids.

    The rows are dealt in ranges of ``doc_id`` (and, for repeated ids, of the
    text's hash), so no partition depends on one source or group of copies."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(WordEndEncoder, tokenizer_path), TaskContext.get().partitionId()
        held, held_ids, shard, before = [], 0, 0, 0

        def flush():
            ids, counts = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays([h[0] for h in held])),
                pa.array([counts], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                pa.array([dac_encode(ids)], pa.binary())], ["part", "shard", "before", "docs", "lens", "n_ids", "code"])

        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for first, k in slices(texts):
                flat, counts = enc.encode(texts.slice(first, k))
                flat = np.insert(flat, np.cumsum(counts), end_id)
                held.append((batch.column(0).slice(first, k), flat, counts + 1))
                held_ids += len(flat)
                if held_ids >= shard_ids:
                    yield flush()
                    held, held_ids, shard, before = [], 0, shard + 1, before + held_ids
        if held:
            yield flush()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    h = F.xxhash64("text")
    (src.repartitionByRange(n, "doc_id", h).sortWithinPartitions("doc_id", h)
     .mapInArrow(run, SHARDS).write.mode("errorifexists").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` (little-endian unsigned 32-bit ids) of
    every document, from the files; ``start`` counts the ids of all documents
    before it.  Only the totals of the written partitions (as many rows as
    partitions) are summed in one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, docs, lens, code in zip(*(batch.column(i) for i in range(4)), strict=True):
                ids = Dac(code.as_py()).all().astype("<u4")
                lens = lens.values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(lens)])
                yield pa.RecordBatch.from_arrays([
                    docs.values, pa.array(ends[:-1] + base.as_py()), pa.array(lens),
                    pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer((ends * 4).astype(np.int32)),
                                                                    pa.py_buffer(ids.tobytes())])],
                    ["doc_id", "start", "n_tokens", "tokens"])

    shards = spark.read.schema(SHARDS).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("of_part"))
    # one row per written partition, so it is broadcast
    return (shards.select("part", "before", "docs", "lens", "code").join(F.broadcast(starts), "part")
            .select((F.col("before") + F.col("of_part")).alias("base"), "docs", "lens", "code")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, tokens binary"))


def token_at(shards: DataFrame, part: int, shard: int, i: int) -> int:
    """One id of one shard, without decoding the shard."""
    row = shards.where((F.col("part") == part) & (F.col("shard") == shard)).select("code").first()
    return Dac(bytes(row["code"])).get(i)
