"""Phrase collocations by top-order marginalisation.

Every word occurrence starts exactly one window of ``max_words`` lead columns
``w1 .. wN``, padded with nulls where its piece ends.  Only these windows are
counted; Spark's ROLLUP over ``(lang, w1, .. wN)`` then sums successively
shorter prefixes, and the count of a prefix is the count of that phrase, so no
phrase length is ever exploded for itself.

Most windows of natural text occur once, so they travel packed: a slice's distinct
windows go, sorted and compressed, to buckets by language, first word and a part of
the second, so all windows that share their first two words meet in one bucket
while a very common first word is spread over several.  There a window is padded
behind the first prefix that stays below ``min_count``, which changes the count of no
phrase that reaches it, and what is left, few rows, goes to the ROLLUP.  The number
of buckets follows the corpus, so a bucket's size does not.

Scores use exact decimals of 38 digits, enough for counts below 10^15.  Null
text holds no words, null lang counts as ``und``, repeated rows count each time,
ids and other columns are not looked at, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_ledger.llm.chunks import slices
from spark_ledger.llm.common import cut_lineage
from spark_ledger.llm.words import mix

SLICE_BYTES = 3_000_000    # text handled at a time
BUCKET_BYTES = 4_000_000   # text whose windows make up one bucket, on average
SPREAD = 16                # buckets that one first word is spread over
HELD = 700_000             # windows of a bucket that are held before they are summed
SALTS = 64                 # parts of a language in the first step of its ranking

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)              # 0 word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


class Words:
    """The words of an array of texts: code of each, distinct words, the text
    it stands in, and whether the next word stands in the same piece."""

    def __init__(self, texts: pa.Array):
        texts = pa.concat_arrays([texts.cast(pa.large_string()), pa.array([], pa.large_string())])
        _, offsets, data = texts.buffers()
        cuts = np.frombuffer(offsets, np.int64)[:len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[:cuts[-1]] if data is not None else np.zeros(0, np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        first = np.zeros(len(raw) + 1, bool)
        first[cuts] = True                                # a text never goes on in the next one
        begin = np.flatnonzero(word & (first[:-1] | ~np.concatenate([[False], word[:-1]])))
        end = np.flatnonzero(word & (first[1:] | ~np.concatenate([word[1:], [False]]))) + 1
        flat = pa.py_buffer(_LOWER[raw][word])
        ends = np.concatenate([[0], np.cumsum(end - begin)])
        coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), flat).dictionary_encode()
        self.distinct = coded.dictionary
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.text = np.searchsorted(cuts, begin, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int64)[begin] if len(begin) else begin
        self.joined = np.zeros(len(begin), bool)
        self.joined[:-1] = (np.diff(piece) == 0) & (np.diff(self.text) == 0)


def hashed(texts: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))


def _batches(batches: Iterator[pa.RecordBatch], size: int):
    """``(texts, lang codes, langs)`` by slices of the batches."""
    for batch in batches:
        texts = batch.column(1).cast(pa.string())
        for first, n in slices(texts, size):
            lang = batch.column(0).cast(pa.string()).slice(first, n).dictionary_encode()
            yield texts.slice(first, n), lang.indices.to_numpy(), lang.dictionary


def lead_windows(words: Words, lang_codes: np.ndarray, max_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows of a slice as columns of codes (language, w1 .. wN; the code
    behind the last word stands for padding), sorted, and their counts."""
    wide = len(words.distinct) + 1
    key, goes, lead, parts = lang_codes[words.text].astype(np.int64) * wide + words.code, words.joined, words.code, []
    for i in range(max_words):                          # windows are numbered by the columns so far
        if i:
            lead = np.append(lead[1:], wide - 1)
            key = group * wide + np.where(goes, lead, wide - 1)
            goes = goes & np.append(words.joined[i:], np.zeros(i, bool))
        used, group = np.unique(key, return_inverse=True)
        parts.append(used)
    columns, number = [], parts[-1]
    for i in reversed(range(max_words)):
        columns.append(number % wide)
        number = number // wide if i == 0 else parts[i - 1][number // wide]
    return [number, *reversed(columns)], np.bincount(group, minlength=len(parts[-1]))


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packed_windows(src: DataFrame, max_words: int, buckets: int) -> DataFrame:
    """``bucket, windows``: packed distinct windows of each slice."""
    names, size = ["lang", *(f"w{i + 1}" for i in range(max_words)), "n"], SLICE_BYTES

    def run(batches):
        for texts, lang_codes, langs in _batches(batches, size):
            words = Words(texts)
            if not len(words.code):
                continue
            columns, n = lead_windows(words, lang_codes, max_words)
            h = np.append(hashed(words.distinct.to_pylist()), np.uint64(0))
            second = h[columns[2]] % np.uint64(SPREAD)
            bucket = (mix(mix(h[columns[1]] + hashed(langs.to_pylist())[columns[0]]) + second) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")       # windows stay sorted within a bucket
            vocabulary = pa.concat_arrays([words.distinct.cast(pa.string()), pa.array([None], pa.string())])
            arrays = [langs.take(pa.array(columns[0][order])), *(vocabulary.take(pa.array(c[order])) for c in columns[1:])]
            table = pa.RecordBatch.from_arrays([*arrays, pa.array(n[order])], names)
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([bucket[order[a]]], pa.int32()), pa.array([_pack(table.slice(a, b - a))], pa.binary())],
                                                 ["bucket", "windows"])

    return src.mapInArrow(run, "bucket int, windows binary")


def _summed(table: pa.Table) -> pa.Table:
    names = table.column_names[:-1]
    out = table.group_by(names, use_threads=False).aggregate([("n", "sum")])
    return out.rename_columns([c if c != "n_sum" else "n" for c in out.column_names]).select([*names, "n"])


def _padded(table: pa.Table, min_count: int) -> pa.Table:
    """Summed windows of a bucket, padded behind the first prefix of two words and
    more that stays below ``min_count``."""
    names, n = table.column_names[:-1], table["n"].to_numpy()

    def codes(column):
        return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)

    prefix = codes(table["lang"]) * (table.num_rows + 1) + codes(table["w1"])
    alive, columns = np.ones(table.num_rows, bool), [table["lang"], table["w1"]]
    for name in names[2:]:
        _, prefix = np.unique(prefix, return_inverse=True)
        prefix = prefix * (table.num_rows + 1) + codes(table[name])
        _, back = np.unique(prefix, return_inverse=True)
        alive = alive & (np.bincount(back, n)[back] >= min_count)
        columns.append(pc.if_else(pa.array(alive), table[name].combine_chunks(), pa.scalar(None, pa.string())))
    return _summed(pa.table([*columns, table["n"]], names=[*names, "n"]))


def window_counts(src: DataFrame, max_words: int, min_count: int, buckets: int) -> DataFrame:
    """``lang, w1 .. wN, n``: windows padded as early as their counts allow."""
    most = HELD

    def run(batches):
        held, size, at = [], 0, None

        def flush():
            if held:
                yield from _padded(_summed(pa.concat_tables(held)), min_count).to_batches(max_chunksize=50_000)

        for batch in batches:
            for bucket, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != at:
                    yield from flush()
                    held, size, at = [], 0, bucket
                held.append(pa.ipc.open_stream(cell.as_buffer()).read_all())
                size += held[-1].num_rows
                if size >= most:
                    held = [_summed(pa.concat_tables(held))]
                    size = held[0].num_rows // 2       # a bucket of ever new windows is summed less and less often
        yield from flush()

    schema = ", ".join(["lang string", *(f"w{i + 1} string" for i in range(max_words)), "n long"])
    return packed_windows(src, max_words, buckets).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, words, phrase, f``: every phrase of 1 to ``max_words`` words that
    occurs ``min_count`` times, and per lang a row of 0 words with all words."""
    src = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                                                         F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    names = [f"w{i + 1}" for i in range(max_words)]
    sums = window_counts(src, max_words, min_count, 1 + size // BUCKET_BYTES).rollup("lang", *names).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("g"))
    length = F.lit(None)
    for k in range(max_words + 1):                          # a prefix of k words; windows padded earlier are no phrase
        full = F.col(names[k - 1]).isNotNull() if k else F.lit(True)
        length = F.when((F.col("g") == 2 ** (max_words - k) - 1) & full, k).otherwise(length)
    return (sums.select("lang", length.cast("int").alias("words"), F.concat_ws(" ", *names).alias("phrase"), "f")
            .where((F.col("words") == 0) | (F.col("words") > 0) & (F.col("f") >= min_count)))


def _joined(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, overlap: int = 50, keep: int = 2000,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``keep`` best phrases of
    each language.  The score of a phrase is that of its worst cut; phrases
    found inside a longer one in ``overlap`` percent of their places go."""
    counts = cut_lineage(phrase_counts(docs, max_words, min_count, lang_col, text_col))
    parts = counts.where("words > 0").select("lang", "phrase", "f")
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    split = F.split("phrase", " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "words", "a", "cut", _joined(split, F.lit(1), F.col("cut")).alias("head"),
                       _joined(split, F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    big = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cuts = cuts.select("lang", "phrase", "words", "a", "cut", "l", "r", (big["a"] * big["a"] * F.lit(1000000)).alias("top"),
                       (big["l"] * big["r"]).alias("bottom")).withColumn("score", F.expr("top div bottom"))
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    inner = phrases.where("words > 2").select("lang", "words", "a", split.alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.expr("sequence(1, words - k + 1)")).alias("i"))
    inner = inner.groupBy("lang", _joined("w", F.col("i"), F.col("k")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = scored.join(inner, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {overlap} * a")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = left.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score",
                       F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    first = Window.partitionBy("lang", "salt").orderBy(*best)      # a language's best are the best of its parts' best
    rows = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= keep)
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return rows.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(max_words: int = 3, min_count: int = 10, overlap: int = 50, keep: int = 2000) -> str:
    """The same rows in DuckDB by counting each length for itself."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS words, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM pieces"
        for k in range(1, max_words + 1))
    return f"""
WITH lines AS (SELECT COALESCE(lang, 'und') AS lang,
         unnest(string_split_regex(translate(COALESCE(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM lines),
f AS MATERIALIZED (SELECT lang, words, phrase, COUNT(*) AS f FROM ({grams}) GROUP BY ALL),
n AS (SELECT lang, SUM(f) AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= {min_count}),
cuts AS (SELECT *, lang || chr(9) || array_to_string(w[1:k], ' ') AS head, lang || chr(9) || array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
tally AS MATERIALIZED (SELECT lang || chr(9) || phrase AS part, f AS n FROM f),
heads AS (SELECT cuts.*, tally.n AS l FROM cuts JOIN tally ON head = part),
scored AS (SELECT heads.*, tally.n AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * tally.n) AS score FROM heads JOIN tally ON rest = part),
worst AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_at AS (SELECT lang, a, words, w, k, unnest(range(1, words - k + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS k FROM cand)),
longer AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, MAX(a) AS most FROM inner_at GROUP BY ALL),
stay AS (SELECT s.* FROM worst s LEFT JOIN longer b USING (lang, phrase) WHERE b.most IS NULL OR 100 * b.most < {overlap} * s.a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= {keep}"""
