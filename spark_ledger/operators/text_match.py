"""Match many texts with many patterns through an index over q-grams.

A pattern that must contain a literal of at least ``GRAM`` characters is looked
up by one gram of it, the one that fewest texts hold, so a (text, pattern) pair is
only tried when the text holds that gram; every pair is then checked exactly.
Patterns without such a literal (short ones, alternations, ...) are few rows of
configuration; they travel to the texts as one array and are tried on each.
No pair of all texts with all patterns is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def required_literal(pattern: Column) -> Column:
    """The longest run of plain characters that every match of a regular
    expression holds; null where that is not certain.

    Escapes, classes and quantified characters end a run; alternations, group
    options, quantified groups, quoting and coded characters give null."""
    unsure = pattern.rlike(r"\||\(\?|\)[?*{]|\\[pPxuNkcQE0-9]|\[\^?\]|&&|\[[^\]]*\[")
    t = F.regexp_replace(pattern, r"\\.", "\u0001")
    t = F.regexp_replace(t, r"\[[^\]]*\]", "\u0001")
    t = F.regexp_replace(t, r"\+[?+]", "+")
    t = F.regexp_replace(t, r"[^\u0001]([?*]|\{[^}]*\})", "\u0001")
    runs = F.split(t, r"[\u0001^$.()+?*{}\[\]]")
    longest = F.element_at(F.array_sort(runs, lambda a, b: F.length(a) - F.length(b)), -1)
    return F.when(~unsure & (F.length(longest) > 0), longest)


def grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` characters."""
    at = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(GRAM)))))


def _fits(text: Column, p: Column) -> Column:
    return F.when(p["kind"] == "regex", F.regexp_like(text, p["pattern"])).otherwise(text.contains(p["pattern"]))


def match_texts(texts: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """``(text, p)`` for each text and each pattern that fits; ``patterns`` has
    ``kind`` ('regex' finds a partial match, 'contains' a literal), ``pattern``
    and any other columns, all kept in the struct ``p``.  Texts must be distinct;
    null texts and null patterns fit nothing."""
    pats = patterns.where("pattern is not null and kind in ('regex', 'contains')")
    literal = F.when(F.col("kind") == "contains", F.col("pattern")).otherwise(required_literal(F.col("pattern")))
    pats = pats.select(F.struct(*pats.columns).alias("p"), literal.alias("literal"))
    indexed = F.length(F.coalesce("literal", F.lit(""))) >= GRAM
    texts = texts.select(text).where(F.col(text).isNotNull())

    of_patterns = pats.where(indexed).select("p", F.explode(grams(F.col("literal"))).alias("gram"))
    of_texts = texts.select(text, F.explode(grams(F.col(text))).alias("gram"))
    of_texts = of_texts.join(of_patterns.select("gram").distinct(), "gram", "left_semi")
    texts_per_gram = of_texts.groupBy("gram").agg(F.count("*").alias("n"))
    # a gram that no text holds shows that the pattern fits nothing
    keyed = of_patterns.join(texts_per_gram, "gram", "left").groupBy("p").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("key")).where("key.n > 0").select("p", "key.gram")
    found = of_texts.join(keyed, "gram").where(_fits(F.col(text), F.col("p"))).select(text, "p")

    rest = pats.where(~indexed).agg(F.collect_list("p").alias("ps"))
    tried = F.filter("__ps", lambda p: F.coalesce(_fits(F.col(text), p), F.lit(False)))
    return found.unionByName(texts.withColumn("__ps", rest.scalar()).select(text, F.explode(tried).alias("p")))
