"""Portfolio allocation tables (J-8a ... J-8d) and dividend estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spark_ledger.functions import month_label
from spark_ledger.operators.common import maybe_broadcast

SEC_COLS = ("asset_class", "region", "style", "size")
ACCT_COLS = ("acct_group", "tax_bucket", "liquidity")


def positions_enriched(positions: DataFrame, security_dim: DataFrame | None,
                       account_dim: DataFrame | None) -> DataFrame:
    """J-8a: positions with security and account attributes; missing -> 'Unknown',
    expense ratio 0.0; a missing dim behaves like an empty one."""
    p = positions
    if security_dim is not None:
        s = maybe_broadcast(security_dim.select("symbol", *SEC_COLS, "expense_ratio"))
        p = p.join(s, "symbol", "left")
    else:
        for c in SEC_COLS + ("expense_ratio",):
            p = p.withColumn(c, F.lit(None).cast("string" if c != "expense_ratio" else "double"))
    if account_dim is not None:
        a = maybe_broadcast(account_dim.select("account_id", *ACCT_COLS))
        p = p.join(a, "account_id", "left")
    else:
        for c in ACCT_COLS:
            p = p.withColumn(c, F.lit(None).cast("string"))
    unk = lambda c: F.coalesce(F.col(c), F.lit("Unknown")).alias(c)
    return p.select(
        "as_of_date", month_label("as_of_date").alias("month"), "account_id",
        *[unk(c) for c in ACCT_COLS], "symbol", *[unk(c) for c in SEC_COLS],
        F.coalesce(F.col("expense_ratio").cast("double"), F.lit(0.0)).alias("expense_ratio"),
        F.col("market_value").cast("double").alias("value"))


def monthly_allocation(pe: DataFrame) -> DataFrame:
    """J-8b: value by month x asset_class x region x style x tax_bucket."""
    return pe.groupBy("month", "asset_class", "region", "style", "tax_bucket").agg(F.sum("value").alias("value"))


def monthly_allocation_by_size(pe: DataFrame) -> DataFrame:
    return pe.groupBy("month", "asset_class", "region", "style", "size", "tax_bucket").agg(
        F.sum("value").alias("value"))


def weighted_expense_ratio(pe: DataFrame) -> DataFrame:
    """J-8c: sum(value*er)/nullif(sum(value),0) by month, asset_class."""
    sv = F.sum("value")
    return pe.groupBy("month", "asset_class").agg(
        (F.sum(F.col("value") * F.col("expense_ratio")) / F.when(sv != 0, sv)).alias("weighted_expense_ratio"))


def allocation_weights(pe: DataFrame) -> DataFrame:
    """J-8d: class value over all positions that month.

    Both sides are aggregated first (month x class, month), so the join is
    between two small aggregates."""
    by_class = pe.groupBy("month", "asset_class").agg(F.sum("value").alias("value"))
    investable = pe.groupBy("month").agg(F.sum("value").alias("investable_value"))
    j = by_class.join(investable, "month", "inner")
    iv = F.col("investable_value")
    return j.select("month", "asset_class", "value", "investable_value",
                    (F.col("value") / F.when(iv != 0, iv)).alias("actual_weight"))


def allocation_vs_target(pe: DataFrame, target_allocation: DataFrame | None) -> DataFrame:
    """J-8d: actual vs target weight; null target -> null variance."""
    w = allocation_weights(pe)
    if target_allocation is None:
        return w.select("month", "asset_class", "actual_weight",
                        F.lit(None).cast("double").alias("target_weight"),
                        F.lit(None).cast("double").alias("variance"))
    t = maybe_broadcast(target_allocation.select("asset_class", "target_weight"))
    j = w.join(t, "asset_class", "left")
    return j.select("month", "asset_class", "actual_weight", "target_weight",
                    (F.col("actual_weight") - F.col("target_weight")).alias("variance"))


def estimated_dividends(pe: DataFrame, security_dim: DataFrame) -> DataFrame:
    """Est Annual Dividends family over the positions export:
    total, taxable, qualified taxable, ordinary taxable (= federal taxable -
    qualified)."""
    cols = ["symbol", "dividend_yield", "qualified_ratio"]
    has_fed = "federal_taxable_ratio" in security_dim.columns
    if has_fed:
        cols.append("federal_taxable_ratio")
    s = maybe_broadcast(security_dim.select(*cols))
    j = pe.join(s, "symbol", "left")
    fed = F.col("federal_taxable_ratio") if has_fed else F.lit(None).cast("double")
    base = F.col("value") * F.col("dividend_yield")
    taxable = F.col("tax_bucket") == "Taxable"
    q = F.sum(F.when(taxable, base * F.col("qualified_ratio") * fed))
    return j.agg(
        F.sum(base).alias("est_annual_dividends"),
        F.sum(F.when(taxable, base)).alias("est_annual_dividends_taxable"),
        q.alias("est_qualified_dividends_taxable"),
        (F.sum(F.when(taxable, base * fed)) - q).alias("est_ordinary_dividends_taxable"))
