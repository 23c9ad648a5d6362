"""Quality rules: fixed counts, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word 1- and 2-grams are counted: a trusted target
(documents labelled as good) and the raw corpus (every document).  A document's
score is the mean over its n-grams of ``log p_target - log p_raw``; below
``threshold`` it is rejected.  The target's smoothing shrinks that mean, so a
second one is taken in which an n-gram counts by what it is expected to occur in
the target: one expected a few times only (a clean word not seen yet) says little,
one expected often and missing (junk) says all.  Below ``evidence_threshold`` a
document is rejected too.  Everything is DataFrame functions: n-grams are
hashed in the row, counted with map-side aggregation into ``buckets`` sums, and
scored against the broadcast table of ``buckets`` weights, whose size does not
depend on the corpus.

Null and empty texts have no words (rejected by the base rule); repeated rows
count and are returned each time; an empty table gives an empty result; without
trusted rows all weights are 0 and only the base rule rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import SPACE, cut_lineage

BUCKETS = 1 << 16
#: trusted documents the target is fit on: the first by hash of their id
TARGET_ROWS = 20_000
#: mean log ratio per n-gram under which a document is rejected; lenient, so that
#: clean documents stay also where few rows are trusted
THRESHOLD = -0.3
#: pseudo-occurrences on both sides of the second ratio, and the mean that rejects
EVIDENCE, EVIDENCE_THRESHOLD = 10.0, -0.12


def words_of(text):
    """Array of words between white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """Words and the fixed counts of every text; ``keep`` are columns to carry."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(*keep, text.alias("_text")).withColumn("_words", words_of(F.col("_text")))
    d = d.withColumn("_h", F.when(F.size("_words") >= 8, F.transform(
        F.sequence(F.lit(1), F.size("_words") - 7), lambda i: F.xxhash64(F.slice("_words", i, 8))))
        .otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    d = d.withColumn("_lines", lines)
    d = d.select(
        *keep, "_words", "_h", F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        (F.size("_h") > F.size(F.array_distinct("_h"))).alias("_rep"))
    # only texts with a repeated window sort their windows with the positions
    d = d.withColumn("_s", F.when(F.col("_rep"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("_at", F.when(F.col("_rep"), F.sort_array(F.filter(F.transform(
        "_s", lambda e, k: F.when((e["h"] == F.get("_s", k - 1)["h"]) | (e["h"] == F.get("_s", k + 1)["h"]), e["i"])),
        lambda x: x.isNotNull()))))
    gaps = F.transform("_at", lambda p, k: F.least(F.lit(8), F.coalesce(F.get("_at", k + 1) - p, F.lit(8))))
    return d.withColumn("n_repeat_words", F.when(F.col("_rep"), F.aggregate(gaps, F.lit(0), lambda a, x: a + x))
                        .otherwise(0).cast("long")).drop("_h", "_s", "_at", "_rep")


def grams_of(words, buckets: int):
    """Buckets of the hashed 1- and 2-grams of an array of words."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda w, i: F.pmod(F.xxhash64(F.get(words, i), w), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def ratio_weights(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``bucket, w, v``: log ratio of target to raw corpus.  For ``w`` the target is
    smoothed by ``buckets`` pseudo-counts in the raw corpus's proportions, so that
    few trusted rows say little; ``v`` compares occurrences in the target with the
    expected ones, ``EVIDENCE`` added to both."""
    some = (trusted_ids.select(F.col("doc_id").alias("_t")).where("_t is not null").distinct()
            .orderBy(F.xxhash64("_t"), "_t").limit(target_rows))
    grams = (docs.join(F.broadcast(some), F.col("doc_id") == F.col("_t"), "left")      # at most target_rows ids
             .select(F.col("_t").isNotNull().cast("int").alias("t"),
                     words_of(F.coalesce("text", F.lit(""))).alias("_words"))
             .select("t", F.explode(grams_of(F.col("_words"), buckets)).alias("bucket")))
    counts = cut_lineage(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target")))
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not total["target"]:
        return counts.select("bucket", F.lit(0.0).alias("w"), F.lit(0.0).alias("v"))
    share = F.col("raw") / F.lit(float(total["raw"]))
    return counts.select("bucket", (F.log((F.col("target") + buckets * share) / share)
                                    - F.lit(math.log(total["target"] + buckets))).alias("w"),
                         F.log((F.col("target") + EVIDENCE) / (float(total["target"]) * share + EVIDENCE)).alias("v"))


def quality(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
            evidence_threshold: float = EVIDENCE_THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, ``score`` (null without words), ``base_failed`` and ``kept`` of
    every document, and the columns ``carry`` as they are; documents are told apart
    by a row key, not by their id, which may be null or repeated."""
    weights = ratio_weights(docs, trusted_ids, buckets)
    d = base_counts(docs, "doc_id", *carry).withColumn("_row", F.monotonically_increasing_id())
    fields = ["doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = (d.select("_row", *fields, F.explode_outer(grams_of(F.col("_words"), buckets)).alias("bucket"))
              .join(F.broadcast(weights), "bucket", "left")                            # at most ``buckets`` rows
              .groupBy("_row", *fields).agg(F.avg("w").alias("score"), F.avg("v").alias("_v")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (scored.drop("_row").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold)
                        & (F.coalesce("_v", F.lit(0.0)) >= evidence_threshold)).drop("_v"))
