"""Tax estimates: progressive brackets and the annual tax summary (K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Federal ordinary brackets, married filing jointly, tax year
# 2025, as (upper bound of taxable income, base tax, marginal rate); the last
# bracket has no upper bound.  The top base (191011) is the model's value and
# is not continuous with the 35% bracket (T-12).
BRACKETS_MFJ_2025 = [
    (23850, 0, 0.10),
    (96950, 2385, 0.12),
    (206700, 11157, 0.22),
    (394600, 35302, 0.24),
    (501050, 80398, 0.32),
    (751600, 114462, 0.35),
    (None, 191011, 0.37),
]
QUALIFIED_EFFECTIVE_RATE = 0.188


def continuous_brackets(brackets=BRACKETS_MFJ_2025):
    """Same thresholds and rates with every base recomputed so the tax is
    continuous at each threshold."""
    out, base, lo = [], 0.0, 0
    for hi, _, rate in brackets:
        out.append((hi, base, rate))
        if hi is not None:
            base = base + (hi - lo) * rate
            lo = hi
    return out


def progressive_tax(income: Column, brackets=BRACKETS_MFJ_2025) -> Column:
    """0 for income <= 0, else base + (income - lower) * rate of its bracket."""
    expr = F.when(income <= 0, F.lit(0.0))
    lo = 0
    for hi, base, rate in brackets:
        v = F.lit(float(base)) + (income - F.lit(float(lo))) * F.lit(rate) if lo else income * F.lit(rate)
        if hi is None:
            return expr.otherwise(v)
        expr = expr.when(income <= hi, v)
        lo = hi
    return expr


def tax_inputs(annual_tax_est: DataFrame) -> DataFrame:
    """Key/value pivot of the tax input table (one row)."""
    m = F.col("metric")

    def pick(k):
        return F.max(F.when(m == k, F.col("value").cast("double"))).alias(k)
    return annual_tax_est.agg(pick("w2_income"), pick("deductions"), pick("w2_taxes"),
                              pick("est_tax_payments"), pick("loss_offset_ordinary"))


def _blank0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def tax_summary(annual_tax_est: DataFrame, est_dividends: DataFrame) -> DataFrame:
    """AGI, Ordinary Income Base, Federal Ordinary/Qualified tax, Projected
    Federal Tax, Remaining Federal Liability, Total Taxes Paid (one row).
    Blank operands count as 0 in sums, as in the model."""
    ti = tax_inputs(annual_tax_est)
    d = est_dividends
    q = d.select("est_qualified_dividends_taxable").scalar()
    o = d.select("est_ordinary_dividends_taxable").scalar()
    x = ti.select("*", q.alias("qualified_div"), o.alias("ordinary_div"))
    w2, ded, loss = _blank0(F.col("w2_income")), _blank0(F.col("deductions")), _blank0(F.col("loss_offset_ordinary"))
    qd, od = _blank0(F.col("qualified_div")), _blank0(F.col("ordinary_div"))
    base = w2 + od + loss + ded
    fed_ord = progressive_tax(base)
    fed_q = qd * F.lit(QUALIFIED_EFFECTIVE_RATE)
    paid = _blank0(F.col("w2_taxes")) + _blank0(F.col("est_tax_payments"))
    return x.select(
        (w2 + od + qd + loss).alias("agi"),
        base.alias("ordinary_income_base"),
        fed_ord.alias("federal_ordinary_tax"),
        fed_q.alias("federal_qualified_tax"),
        (fed_ord + fed_q).alias("projected_federal_tax"),
        (fed_ord + fed_q - paid).alias("remaining_federal_liability"),
        paid.alias("total_taxes_paid"))
