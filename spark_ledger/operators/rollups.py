"""Monthly cash-flow, actuals and net-worth rollups (J-3 ... J-7).

Money sums are taken over integer cents (exact, independent of summation
order) and turned into DOUBLE at the end.  Dimension joins are left joins
behind a checked broadcast bound; the aggregations are hash aggregates with
map-side partial aggregation, so a hot month costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spark_ledger.functions import month_label, round_to
from spark_ledger.operators.common import maybe_broadcast

LEVEL_COLS = ("level1", "level2", "level3", "parent", "group_1", "group_2")


def category_enriched(category_dim: DataFrame) -> DataFrame:
    """J-3: category plus whichever hierarchy columns the dim carries."""
    return category_dim.select("category", *[c for c in LEVEL_COLS if c in category_dim.columns])


def non_transfer(twc: DataFrame, category_dim: DataFrame | None) -> DataFrame:
    """Left join to the category dim and drop transfer categories.

    Rows whose category is not in the dim are kept (null flag = not transfer).
    """
    if category_dim is None or not {"category", "is_transfer"} <= set(category_dim.columns):
        return twc
    cd = maybe_broadcast(category_dim.select(F.col("category").alias("__cd_cat"),
                                             F.col("is_transfer").alias("__cd_is_transfer")))
    j = twc.join(cd, twc["category"] == cd["__cd_cat"], "left")
    return j.filter(~F.coalesce(F.col("__cd_is_transfer"), F.lit(False))).drop("__cd_cat", "__cd_is_transfer")


def _cents(twc: DataFrame):
    if "amount_cents" in twc.columns:
        return F.col("amount_cents")
    return F.round(F.col("amount") * 100).cast("long")


def _dbl(c):
    return c.cast("double") / F.lit(100.0)


def monthly_cashflow(twc: DataFrame, category_dim: DataFrame | None = None) -> DataFrame:
    """J-4: month ('YYYY-MM'), income (>0), spending (<0, negative), net."""
    t = non_transfer(twc, category_dim).select(month_label("date").alias("month"), _cents(twc).alias("c"))
    return t.groupBy("month").agg(
        _dbl(F.sum(F.when(F.col("c") > 0, F.col("c")).otherwise(0))).alias("income"),
        _dbl(F.sum(F.when(F.col("c") < 0, F.col("c")).otherwise(0))).alias("spending"),
        _dbl(F.sum("c")).alias("net_cashflow"))


def monthly_actuals_by_category(twc: DataFrame, category_dim: DataFrame | None = None) -> DataFrame:
    """J-5: month, category, actual_signed, spending (outflows as positive)."""
    t = non_transfer(twc, category_dim).select(
        month_label("date").alias("month"),
        F.coalesce(F.col("category"), F.lit("Uncategorized")).alias("category"),
        _cents(twc).alias("c"))
    return t.groupBy("month", "category").agg(
        _dbl(F.sum("c")).alias("actual_signed"),
        _dbl(F.sum(F.when(F.col("c") < 0, -F.col("c")).otherwise(0))).alias("spending"))


def monthly_actuals_enriched(twc: DataFrame, category_dim: DataFrame) -> DataFrame:
    """J-6: J-5 plus the hierarchy columns of ``category_enriched``.

    Pre-aggregated to (month, category) first, then the small result is
    joined to the dim and re-grouped (a category can repeat in the dim)."""
    lv = [c for c in LEVEL_COLS if c in category_dim.columns]
    t = non_transfer(twc, category_dim).select(
        month_label("date").alias("month"),
        F.coalesce(F.col("category"), F.lit("Uncategorized")).alias("category"),
        _cents(twc).alias("c"))
    pre = t.groupBy("month", "category").agg(
        F.sum("c").alias("s"), F.sum(F.when(F.col("c") < 0, -F.col("c")).otherwise(0)).alias("sp"))
    if not lv:
        return pre.select("month", "category", _dbl(F.col("s")).alias("actual_signed"),
                          _dbl(F.col("sp")).alias("spending"))
    ce = maybe_broadcast(category_enriched(category_dim).withColumnRenamed("category", "__ce_cat"))
    j = pre.join(ce, pre["category"] == ce["__ce_cat"], "left")
    return j.groupBy("month", "category", *lv).agg(
        _dbl(F.sum("s")).alias("actual_signed"), _dbl(F.sum("sp")).alias("spending"))


# ------------------------------------------------------------ net worth ---

def balances_enriched(balance_snapshot: DataFrame, account_dim: DataFrame) -> DataFrame:
    """J-7 view: month keys, account attributes, liabilities negated."""
    a = maybe_broadcast(account_dim.select("account_id", "account_name", "type", "acct_group", "tax_bucket",
                                           "liquidity", "include_networth", "include_liquid"))
    b = balance_snapshot.join(a, "account_id", "left")
    liability = F.lower(F.coalesce(F.col("type"), F.lit(""))) == "liability"
    bal = F.col("balance").cast("double")
    return b.select(
        F.trunc("as_of_date", "month").alias("month_date"),
        month_label("as_of_date").alias("month"),
        "account_id", "account_name", "type", "acct_group", "tax_bucket", "liquidity",
        "include_networth", "include_liquid",
        F.when(liability, -1.0 * bal).otherwise(bal).alias("balance_norm"))


def _sum_if(cond, v=None):
    # CASE WHEN cond THEN v ELSE 0 END — a null condition counts as false.
    v = F.col("balance_norm") if v is None else v
    return F.sum(F.when(cond, v).otherwise(F.lit(0.0)))


def monthly_net_worth(balance_snapshot: DataFrame, account_dim: DataFrame, scale: int | None = 2) -> DataFrame:
    """J-7: net_worth, assets, liabilities, liquid_net_worth, investable_assets."""
    be = balances_enriched(balance_snapshot, account_dim)
    inc, v = F.col("include_networth"), F.col("balance_norm")
    aggs = [
        _sum_if(inc).alias("net_worth"),
        _sum_if(inc & (v > 0)).alias("assets"),
        _sum_if(inc & (v < 0)).alias("liabilities"),
        _sum_if(F.col("include_liquid")).alias("liquid_net_worth"),
        _sum_if(inc & F.col("liquidity").isin("investable")).alias("investable_assets"),
    ]
    out = be.groupBy("month").agg(*aggs)
    return _round_cols(out, ["net_worth", "assets", "liabilities", "liquid_net_worth", "investable_assets"], scale)


def monthly_net_worth_by_group(balance_snapshot: DataFrame, account_dim: DataFrame, scale: int | None = 2) -> DataFrame:
    be = balances_enriched(balance_snapshot, account_dim)
    out = be.groupBy("month", "acct_group").agg(_sum_if(F.col("include_networth")).alias("value"))
    return _round_cols(out, ["value"], scale)


def net_worth_eop(monthly: DataFrame, by: list[str] | None = None, value_cols=("net_worth",)) -> DataFrame:
    """Semi-additive end-of-period value: per ``by`` group, the value at the
    last month in context (single month -> that month)."""
    by = by or []
    if not by:
        last = monthly.agg(F.max("month")).scalar()
        return monthly.filter(F.col("month") == last).agg(*[F.sum(c).alias(c) for c in value_cols])
    last = monthly.groupBy(*by).agg(F.max("month").alias("__last"))
    j = monthly.join(last, by, "inner")
    return j.filter(F.col("month") == F.col("__last")).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in value_cols])


def _round_cols(df: DataFrame, cols, scale):
    if scale is None:
        return df
    return df.select(*[round_to(c, scale).alias(c) if c in cols else F.col(c) for c in df.columns])
