"""Text normalization as built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Merchant stopwords (must equal the reference list; entries with
# a dot can never match because punctuation is removed first).
MERCHANT_STOPWORDS = [
    "inc", "inc.", "llc", "llc.", "co", "co.", "corp", "corp.", "ltd", "ltd.",
    "the", "store", "stores", "company", "companies",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# After punctuation is turned into spaces a token is ``[a-z0-9]+``, so only
# the dot-free stopwords can ever match; they are removed as whole tokens.
_STOP_RE = "(?<=^| )(?:" + "|".join(w for w in MERCHANT_STOPWORDS if w.isalnum()) + ")(?= |$)"


def normalize_merchant(c) -> Column:
    """lower -> non-alphanumeric runs to one space -> drop stopwords -> join.

    Null input gives the empty string (the reference treats non-text as '').
    Pure regex replacement (whole-stage codegen; no higher-order functions):
    stopword tokens are deleted between zero-width token boundaries, then the
    spaces are collapsed."""
    s = F.trim(F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9]+", " "))
    s = F.regexp_replace(s, _STOP_RE, "")
    return F.trim(F.regexp_replace(s, " {2,}", " "))


def normalize_merchant_v1(c) -> Column:
    """Older variant: lower, delete ``[^a-z0-9 ]``, collapse spaces, trim."""
    s = F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9 ]+", "")
    return F.trim(F.regexp_replace(s, "\\s+", " "))


def regexp_replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace only the first match (the reference's SQL replace without 'g').

    Implemented by anchoring a lazy prefix: ``^(.*?)PAT`` -> ``$1REP``; the
    anchor can only match once, so exactly the leftmost match is replaced.
    """
    return F.regexp_replace(_c(c), f"(?s)^(.*?){pattern}", "$1" + replacement)


def desc_norm(c, mode: str = "first") -> Column:
    """Description normalization used by the dedupe key.

    ``first`` reproduces the reference (each replace hits only its first
    match); ``all`` is the fully normalized form.
    """
    s = F.lower(_c(c))
    if mode == "all":
        return F.regexp_replace(F.regexp_replace(s, "[^a-z0-9 ]", " "), "\\s+", " ")
    return regexp_replace_first(regexp_replace_first(s, "[^a-z0-9 ]", " "), "\\s+", " ")


def slug_symbol(c) -> Column:
    """Fund name -> symbol.

    trim; whitespace runs -> '_'; drop chars outside ``[A-Za-z0-9_]``; collapse
    and strip '_'; upper.  Empty result becomes ``UNKNOWN_FUND``.
    """
    s = F.trim(F.coalesce(_c(c), F.lit("")))
    s = F.regexp_replace(s, "\\s+", "_")
    s = F.regexp_replace(s, "[^A-Za-z0-9_]+", "")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_+|_+$", "")
    return F.when(s == "", F.lit("UNKNOWN_FUND")).otherwise(F.upper(s))


def nullif_blank(c) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    t = F.trim(_c(c))
    return F.when(t == "", F.lit(None)).otherwise(t)
