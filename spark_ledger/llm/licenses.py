"""License scans: phrases, and an exact set-similarity join with templates.

A text block (line) meets a template when it holds at least ``THRESHOLD`` per
cent of the template's distinct words.  All such pairs are found by filters that
lose nothing: words of templates are ordered by their frequency in the whole
corpus, the rarest first (words of no template are rarer than all and can never
match); if a block shares ``c`` words with a template, one of the first
``|T| - c + 1`` words of the template is among the first ``|B| - c + 1`` of the
block.  Blocks that are too short, and matches whose positions leave fewer than
``c`` words behind them, are dropped before the overlap is counted.

Every text is cut into words once: phrases are found there, and the templates' words
and line breaks are written as a narrow table from which frequencies and blocks come.

Only DataFrame functions are used.  What is broadcast or collected is the
template vocabulary, whose size is that of the template list.  Null and empty
texts have no words; repeated rows give repeated results; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_ledger.llm.common import ascii_lower, shared_path

ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: fixed values: phrase -> label
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: template label -> words of a notice
TEMPLATES = {
    "notice:apache-2.0": "licensed under the apache license version 2 0",
    "notice:cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "notice:gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "notice:mit": "released under the mit license",
    "text:agpl": "you should have received a copy of the gnu affero general public license along with this program",
    "text:apache-2.0": "unless required by applicable law or agreed to in writing software distributed under the license "
                       "is distributed on an as is basis without warranties or conditions of any kind",
    "text:bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
                "that the following conditions are met",
    "text:cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "text:gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation",
    "text:isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                "hereby granted",
    "text:mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files",
    "text:mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "text:unlicense": "this is free and unencumbered software released into the public domain",
}
THRESHOLD = 80


def _in(words, vocabulary):
    """Lower-cased words that belong to a small vocabulary (the exact lower case
    is only made for words that fit in any case)."""
    near = F.filter(words, lambda w: F.lower(w).isin(vocabulary))
    return F.filter(F.transform(near, ascii_lower), lambda w: w.isin(vocabulary))


def needed(size: int, threshold: int) -> int:
    """Words that a block must share with a template of ``size`` words."""
    return max(1, -(-size * threshold // 100))


def cut_texts(docs: DataFrame, vocabulary: list[str], phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, found`` (base labels) and
    ``near``: words of the vocabulary, lower-cased, and line breaks, in their order.

    Texts are cut into words here and nowhere else; the array stands in a generator,
    so it is made once for all columns."""
    texts = docs.select("doc_id", F.explode(F.array(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"\n|{ANY_CASE_WORD}"), F.lit(0)))).alias("all"))
    d = texts.select("doc_id", "all", F.explode(F.array(_in(F.col("all"), ["\n", *sorted({*vocabulary, *" ".join(phrases).split()})]))).alias("near"))
    may = F.lit(False)
    for phrase in phrases:
        hit = F.lit(True)
        for word in phrase.split():
            hit = hit & F.array_contains("near", word)
        may = may | hit
    breaks = F.size(F.filter("near", lambda w: w == "\n"))
    words = F.when(may, F.transform(F.filter("all", lambda w: w != "\n"), ascii_lower))        # the others have no place
    d = d.select("doc_id", "near", (F.size("all") - breaks).cast("long").alias("n_words"), words.alias("w"))
    d = d.select("doc_id", "near", "n_words", F.concat(*(_places(phrase.split(), label) for phrase, label in phrases.items())).alias("hits"))
    at = F.transform("hits", lambda h: h["at"])
    d = d.select("doc_id", "near", "n_words", F.coalesce(F.size("hits"), F.lit(0)).alias("n"), at.alias("at"),
                 F.transform("hits", lambda h: h["label"]).alias("labels"))
    return d.select("doc_id", "near", "n_words", F.greatest("n", F.lit(0)).cast("long").alias("n_base"), F.array_min("at").alias("first_word"),
                    F.array_max("at").alias("last_word"), F.coalesce(F.array_sort(F.array_distinct("labels")), F.array().cast("array<string>"))
                    .alias("found"))


def vocabulary_order(cut: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template vocabulary, rarest in the corpus first."""
    counts = cut.select(F.explode("near").alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}       # at most the vocabulary
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def block_matches(cut: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, block, label, containment``: every line (numbered from 0) and
    template with at least ``threshold`` per cent of the template's words, from
    ``cut_texts`` over the templates' words."""
    sets = {label: set(text.split()) for label, text in templates.items()}
    order = vocabulary_order(cut, sorted(set().union(*sets.values())))
    rank = {w: i for i, w in enumerate(order)}
    tokens, rows = [], []
    for label, words in sorted(sets.items()):
        ranks, c = sorted(rank[w] for w in words), needed(len(words), threshold)
        rows.append(F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, ranks)).alias("t_ranks"), F.lit(c).alias("c")))
        tokens += [(label, r, i, len(ranks), c) for i, r in enumerate(ranks[:len(ranks) - c + 1])]
    first = sorted({order[t[1]] for t in tokens})
    least = min(t[4] for t in tokens)
    one = cut.sparkSession.range(1)
    prefix = one.select(F.inline(F.array(*(F.struct(F.lit(a).alias("label"), F.lit(r).alias("rank"), F.lit(i).alias("t_pos"),
                                                    F.lit(n).alias("t_size"), F.lit(c).alias("c")) for a, r, i, n, c in tokens))))
    table = one.select(F.inline(F.array(*rows)))
    near = cut.where(F.arrays_overlap("near", F.array(*map(F.lit, first))))
    ends = F.filter(F.transform("near", lambda w, i: F.when(w == "\n", i + 1)), lambda i: i.isNotNull())     # line breaks, from 1
    lines = F.zip_with(F.concat(F.array(F.lit(0)), ends), F.concat(ends, F.array(F.size("near") + 1)),
                       lambda a, b: F.slice("near", a + 1, b - a - 1))
    places = F.array(*map(F.lit, order))
    ranks = F.sort_array(F.transform(F.filter(F.array_distinct("line"), lambda w: w.isin(order)), lambda w: (F.array_position(places, w) - 1).cast("int")))
    blocks = (near.select("doc_id", F.posexplode(lines).alias("block", "line"))
              .select("doc_id", "block", ranks.alias("ranks")).where(F.size("ranks") >= least))
    pairs = (blocks.select("doc_id", "block", "ranks", F.posexplode("ranks").alias("pos", "rank"))
             .join(F.broadcast(prefix), "rank")
             .where((F.size("ranks") >= F.col("c")) & (F.col("pos") <= F.size("ranks") - F.col("c"))
                    & (1 + F.least(F.col("t_size") - F.col("t_pos") - 1, F.size("ranks") - F.col("pos") - 1) >= F.col("c")))
             .groupBy("doc_id", "block", "label").agg(F.first("ranks").alias("ranks")))
    shared = F.size(F.array_intersect("ranks", "t_ranks"))
    return (pairs.join(F.broadcast(table), "label").where(shared >= F.col("c"))
            .select("doc_id", "block", "label", (shared / F.size("t_ranks")).alias("containment")))


def _places(parts: list[str], label: str):
    """Starts of a phrase in the words ``w``, as (at, label)."""
    whole = F.array(*map(F.lit, parts))
    at = F.transform("w", lambda x, i: F.when((x == parts[0]) & F.slice("w", i + 1, len(parts)).eqNullSafe(whole),
                                              F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))))
    return F.filter(at, lambda x: x.isNotNull())


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document with its phrases' places and all labels; ``score`` is
    1 for a phrase, else the largest containment of a matching block."""
    spark = docs.sparkSession
    path = shared_path(spark, "licenses")
    cut_texts(docs, sorted(set(" ".join(templates.values()).split()))).write.parquet(path)
    cut = spark.read.parquet(path)
    per_doc = block_matches(cut, templates, threshold).groupBy("doc_id").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    return (cut.drop("near").join(per_doc, "doc_id", "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union("found", F.coalesce("more", none))), ",").alias("labels"),
                    F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")))


def oracle_sql(templates: dict[str, str] = TEMPLATES, threshold: int = THRESHOLD) -> str:
    """The same rows from brute force in DuckDB."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    quote = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    ph = ", ".join(f"('{v}', {quote(k.split())})" for k, v in PHRASES.items())
    tp = ", ".join(f"('{k}', {quote(sorted(set(v.split())))}, {needed(len(set(v.split())), threshold)})" for k, v in templates.items())
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{up}', '{low}') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS ws FROM d),
ph(label, parts) AS (VALUES {ph}),
hits AS (SELECT doc_id, label, i FROM (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM w) x JOIN ph
         ON ws[i + 1] = parts[1] AND ws[i + 1:i + len(parts)] = parts),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY doc_id),
tp(label, parts, c) AS (VALUES {tp}),
b AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{word}')) AS bs FROM d),
m AS (SELECT doc_id, label, len(list_intersect(bs, parts)) / len(parts) AS f FROM b JOIN tp
      ON len(bs) >= c AND len(list_intersect(bs, parts)) >= c),
every AS (SELECT doc_id, label FROM hits UNION SELECT doc_id, label FROM m),
lab AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id),
best AS (SELECT doc_id, max(f) AS f FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(f, 0) END AS DOUBLE) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN lab USING (doc_id) LEFT JOIN best USING (doc_id)"""
