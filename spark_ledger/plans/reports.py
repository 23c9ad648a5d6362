"""Report queries (L-1 ... L-13) composed from the operators.

Each report is a function of DataFrames plus explicit filter parameters
(the report's slicers); nothing depends on hidden selection state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spark_ledger.operators.common import maybe_broadcast
from spark_ledger.operators.rollups import non_transfer


def spending_rollup(twc: DataFrame, category_dim: DataFrame) -> DataFrame:
    """L-1: hierarchical subtotals top_bucket > parent > category > description
    > date of the amount, transfers removed; ``level`` is grouping_id()
    (0 = leaf, 31 = grand total)."""
    cd = maybe_broadcast(category_dim.select(F.col("category").alias("__c"), "parent_category", "top_bucket"))
    t = non_transfer(twc, category_dim)
    j = t.join(cd, t["category"] == cd["__c"], "left")
    keys = ["top_bucket", "parent_category", "category", "description", "date"]
    return j.rollup(*keys).agg(
        F.grouping_id().alias("level"),
        (F.sum("amount_cents").cast("double") / 100.0).alias("amount"))


def portfolio_rollup(pe: DataFrame, month: str | None = None, exclude_region: str = "Cash") -> DataFrame:
    """L-6: rollup region > size > style > symbol of value and its share of the
    selected total, for one month (default: the latest month)."""
    if month is None:
        sel = pe.filter(F.col("month") == pe.agg(F.max("month")).scalar())
    else:
        sel = pe.filter(F.col("month") == F.lit(month))
    sel = sel.filter(F.col("region") != exclude_region)
    r = sel.rollup("region", "size", "style", "symbol").agg(
        F.grouping_id().alias("level"), F.sum("value").alias("value"))
    total = sel.agg(F.sum("value")).scalar()
    return r.withColumn("pct", F.col("value") / F.when(total != 0, total))


def spend_vs_budget(twc: DataFrame, category_dim: DataFrame, budget_to_date: DataFrame,
                    excluded_parents: list[str], buckets: list[str] | None = None) -> DataFrame:
    """L-4: per parent category — Budget to Date, Actual Spend (outflows),
    Budget Variance; filtered by top bucket and excluded parents."""
    cd = maybe_broadcast(category_dim.select(F.col("category").alias("__c"), "parent_category", "top_bucket"))
    t = non_transfer(twc, category_dim)
    j = t.join(cd, t["category"] == cd["__c"], "inner")
    if buckets:
        j = j.filter(F.col("top_bucket").isin(*buckets))
    j = j.filter(~F.col("parent_category").isin(*excluded_parents))
    actual = j.groupBy("parent_category").agg(
        (-F.sum("amount_cents").cast("double") / 100.0).alias("actual_spend"))
    b = budget_to_date.filter(~F.col("parent_category").isin(*excluded_parents))
    out = actual.join(b, "parent_category", "full")
    return out.select("parent_category", "budget_to_date", "actual_spend",
                      (F.col("budget_to_date") - F.coalesce(F.col("actual_spend"), F.lit(0.0))).alias("budget_variance"))


def slicer_values(df: DataFrame, col: str) -> DataFrame:
    """L-13: distinct slicer values, newest first."""
    return df.select(col).distinct().orderBy(F.col(col).desc())
