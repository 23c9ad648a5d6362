"""Money parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(c) -> Column:
    """'$1,234.50' -> 1234.5; '(12)' -> -12; unparseable or null -> null."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), "[,$]", "")
    neg = s.startswith("(") & s.endswith(")")
    core = F.trim(F.regexp_replace(s, "^[()]+|[()]+$", ""))
    v = core.try_cast("double")
    return F.when(neg, -v).otherwise(v)


def to_cents(c) -> Column:
    """Amount -> integer cents, half-even rounding; failure -> 0."""
    s = F.trim(F.regexp_replace(_c(c).cast("string"), "[$,]", ""))
    v = s.try_cast("double")
    return F.coalesce(F.bround(v * 100, 0).try_cast("long"), F.lit(0).cast("long"))


def cents_to_amount(c) -> Column:
    """Integer cents -> DOUBLE amount (not DECIMAL)."""
    return _c(c).cast("double") / F.lit(100.0)


def round_money(c, scale: int = 2) -> Column:
    """Presentation rounding for double sums (sums of doubles depend on order)."""
    return F.round(_c(c), scale)


def round_to(c, scale: int = 2) -> Column:
    """round(x * 10^s) / 10^s on DOUBLE — evaluated identically by SQL
    engines (integer rounding of the same IEEE product), unlike decimal
    rounding of a double."""
    f = float(10 ** scale)
    return F.round(_c(c) * f) / f


def bround_money(c, scale: int = 2) -> Column:
    """Half-even rounding to cents (the ingest convention, T-7)."""
    return F.bround(_c(c), scale)
