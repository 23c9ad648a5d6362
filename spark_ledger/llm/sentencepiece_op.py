"""SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the model crosses from a character into a whitespace marker, so a
text is the sequence of its marked words (a run of markers with the word behind
it).  Each distinct marked word is segmented once per worker by the library and
the ids are joined back by position; decoding gathers the bytes of the pieces.

Null text counts as empty; an empty text has no ids and decodes to the empty
string.  Repeated rows give repeated results, an empty table an empty result,
and columns of the input other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.chunks import SentencePieceEncoder, encoder, slices


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded string)`` of every text, as the library
    encodes it without begin or end ids and decodes those ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SentencePieceEncoder, model_path)
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for first, n in slices(texts):
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
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
