"""Budgets: roll-forward of monthly budgets (J-16) and Budget to Date (K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spark_ledger.functions import index_to_yyyymm, yyyymm_to_index
from spark_ledger.operators.common import require_columns


def target_from_transactions(txns: DataFrame, date_col: str = "date") -> Column:
    """Month (yyyymm) of the latest parseable transaction date, as a scalar
    subquery (column-pruned scan: only the date column is read)."""
    mx = txns.select(F.col(date_col).cast("string").try_cast("date").alias("d")).agg(F.max("d").alias("d"))
    return mx.select((F.year("d") * 100 + F.month("d")).cast("int")).scalar()


def budget_roll_forward(budgets: DataFrame, target) -> DataFrame:
    """J-16, H-5: per category, fill months missing between explicit budget months
    and after the last one up to ``target`` (yyyymm, int or Column) with the
    last known amount.  Categories with no month <= target get nothing; rows
    after the target are kept; of several rows of one month the last by ``row_idx`` counts, for the month
    itself and for the months filled from it (without ``row_idx`` the largest).

    A ``lead`` over each category's months gives the next explicit month;
    the gap is one ``explode(sequence)``.  Windows are per category and hold
    one row per budget month."""
    require_columns(budgets, ("parent_category", "yyyymm", "budget_amount"), "budgets")
    order = F.col("row_idx") if "row_idx" in budgets.columns else F.col("budget_amount")
    b = budgets.groupBy(F.trim(F.col("parent_category").cast("string")).alias("parent_category"), F.col("yyyymm").cast("int").alias("yyyymm")).agg(
        F.max_by(F.col("budget_amount").cast("double"), order).alias("budget_amount"))
    tgt = target if isinstance(target, Column) else F.lit(int(target))
    le = b.filter(F.col("yyyymm") <= tgt).withColumn("__i", yyyymm_to_index(F.col("yyyymm")))
    w = Window.partitionBy("parent_category").orderBy("__i")
    le = le.withColumn("__next", F.lead("__i").over(w)).withColumn("__tgt", yyyymm_to_index(tgt))
    last = F.coalesce(F.col("__next") - 1, F.col("__tgt"))
    fill = F.when(last >= F.col("__i") + 1, F.sequence(F.col("__i") + 1, last)).otherwise(F.array().cast("array<int>"))
    adds = le.select("parent_category", F.explode(fill).alias("__m"), "budget_amount").select(
        "parent_category", index_to_yyyymm(F.col("__m")).alias("yyyymm"), "budget_amount")
    return b.unionByName(adds)


def budget_to_date(txns: DataFrame, budgets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Budget to Date per (year, parent_category): full months before the
    latest transaction month of that year plus the latest month's budget
    prorated by day / days-in-month.  The latest date ignores category
    filters; a year without transactions gives null."""
    latest = txns.groupBy(F.year("date").alias("year")).agg(F.max("date").alias("__latest"))
    b = budgets.select("parent_category", F.floor(F.col("yyyymm") / 100).cast("int").alias("year"),
                       F.to_date(F.concat(F.col("yyyymm").cast("string"), F.lit("01")), "yyyyMMdd").alias("__ms"),
                       "budget_amount")
    j = b.join(latest, "year", "inner")
    lm = F.trunc("__latest", "month")
    frac = F.dayofmonth("__latest").cast("double") / F.dayofmonth(F.last_day("__latest")).cast("double")
    return j.groupBy("year", "parent_category").agg(
        (F.coalesce(F.sum(F.when(F.col("__ms") < lm, F.col("budget_amount"))), F.lit(0.0))
         + F.coalesce(F.sum(F.when(F.col("__ms") == lm, F.col("budget_amount"))), F.lit(0.0)) * F.first(frac))
        .alias("budget_to_date"))
